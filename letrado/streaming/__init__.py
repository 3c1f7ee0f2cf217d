"""Event stream: parse -> validate -> enrich -> quarantine / upsert.

The same column functions serve the batch form (``spark.read``) and the
streaming form (``spark.readStream`` + ``foreachBatch``).
"""
