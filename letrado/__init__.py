"""letrado: a Spark-native medallion pipeline for municipal literacy indicators.

Bronze -> silver -> gold -> features -> model, plus data-quality checks,
observability tables and a Structured Streaming upsert path.  Every public
function is ``DataFrame -> DataFrame`` built from built-in Spark operators.
"""

__version__ = "0.1.0"
PIPELINE_VERSION = "1.0.0"
