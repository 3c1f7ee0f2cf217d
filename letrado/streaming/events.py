"""Event message parsing, validation and enrichment (Column functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letrado import PIPELINE_VERSION
from letrado.functions.scalar import clean_double

# Every payload field is read as text and cast per value afterwards: a field
# with the wrong JSON type would otherwise turn into NULL silently.
PAYLOAD_SCHEMA = T.StructType([
    T.StructField("id_municipio", T.StringType()),
    T.StructField("ano", T.StringType()),
    T.StructField("indicador_alfabetizacao", T.StringType()),
    T.StructField("quantidade_matriculas", T.StringType()),
    T.StructField("fonte", T.StringType()),
])
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("payload", PAYLOAD_SCHEMA),
    T.StructField("_corrupt_record", T.StringType()),
])

# Fixed values of the event contract.
DEFAULT_YEAR = 2024            # payload without "ano"
STREAM_SOURCE = "streaming_pubsub"
STREAM_LAYER = "bronze_streaming"
INDICATOR_BOUNDS = (0.0, 100.0)
# Plausible event times: from this day on, and at most this long after the
# message was received (clocks may differ; only checked where the time of
# receipt is known).  Anything else is quarantined, never dropped.
EARLIEST_EVENT = "2000-01-01 00:00:00"
LARGEST_LEAD = "1 day"

# Reject reasons, in the order they are tested.
REJECT_CORRUPT = "registro_corrompido"
REJECT_NO_ID = "sem_id_municipio"
REJECT_NO_TIME = "sem_timestamp"
REJECT_BAD_TIME = "timestamp_implausivel"
REJECT_BAD_VALUE = "indicador_invalido"
REJECT_OUT_OF_RANGE = "indicador_fora_do_intervalo"

FLAT_COLS = ["event_id", "event_type", "event_timestamp", "id_municipio", "ano",
             "indicador_alfabetizacao", "quantidade_matriculas", "fonte"]


def decode_base64(c: Column | str) -> Column:
    """Push-delivery message body: base64 text -> UTF-8 JSON text."""
    col = F.col(c) if isinstance(c, str) else c
    return F.decode(F.unbase64(col), "UTF-8")


def parse_messages(df: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text -> typed event struct; malformed text lands in
    ``_corrupt_record`` (per row, not per file)."""
    parsed = F.from_json(F.col(value_col), EVENT_SCHEMA,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    rest = [c for c in df.columns if c != value_col]
    # Expanding the struct through a generator keeps later filters on parsed
    # fields above the parse: pushed below a plain projection they would
    # re-evaluate from_json for every row a second time.
    return df.select(*rest, F.inline(F.array(parsed)))


def flatten_events(parsed: DataFrame) -> DataFrame:
    """payload.* -> flat columns with defaults: id '' when absent, year 2024."""
    p = lambda f: F.col(f"payload.{f}")
    rest = [c for c in parsed.columns if c not in ("event_id", "event_type", "timestamp", "payload",
                                                   "_corrupt_record")]
    return parsed.select(
        F.col("event_id"),
        F.col("event_type"),
        F.col("timestamp").try_cast("timestamp_ntz").alias("event_timestamp"),
        F.coalesce(p("id_municipio"), F.lit("")).alias("id_municipio"),
        F.coalesce(p("ano").try_cast("int"), F.lit(DEFAULT_YEAR)).alias("ano"),
        clean_double(p("indicador_alfabetizacao").try_cast("double")).alias("indicador_alfabetizacao"),
        p("quantidade_matriculas").try_cast("bigint").alias("quantidade_matriculas"),
        p("fonte").alias("fonte"),
        p("indicador_alfabetizacao").alias("_indicador_raw"),
        F.col("_corrupt_record"),
        *rest,
    )


def reject_reason(flat: DataFrame) -> Column:
    v = F.col("indicador_alfabetizacao")
    lo, hi = INDICATOR_BOUNDS
    at = F.col("event_timestamp")
    implausible = at < F.lit(EARLIEST_EVENT).cast("timestamp_ntz")
    if "_received_at" in flat.columns:
        implausible = implausible | (at > F.col("_received_at").cast("timestamp_ntz") + F.expr(f"INTERVAL {LARGEST_LEAD}"))
    return (F.when(F.col("_corrupt_record").isNotNull(), F.lit(REJECT_CORRUPT))
            .when(F.length(F.col("id_municipio")) == 0, F.lit(REJECT_NO_ID))
            .when(at.isNull(), F.lit(REJECT_NO_TIME))
            .when(implausible, F.lit(REJECT_BAD_TIME))
            .when(F.col("_indicador_raw").isNotNull() & v.isNull(), F.lit(REJECT_BAD_VALUE))
            .when(v.isNotNull() & ((v < lo) | (v > hi)), F.lit(REJECT_OUT_OF_RANGE))
            .otherwise(F.lit(None).cast("string")))


def validate_events(flat: DataFrame) -> DataFrame:
    """Adds ``reject_reason`` (NULL = valid) and ``is_valid``."""
    return (flat.withColumn("reject_reason", reject_reason(flat))
                .withColumn("is_valid", F.col("reject_reason").isNull()))


def enrich_events(valid: DataFrame, processing_date: Column | None = None) -> DataFrame:
    """Processing metadata of the bronze stream layer."""
    return valid.withColumns({
        "_source": F.lit(STREAM_SOURCE),
        "_layer": F.lit(STREAM_LAYER),
        "_processing_date": processing_date if processing_date is not None else F.current_date(),
        "_pipeline_version": F.lit(PIPELINE_VERSION),
    })


def prepare_events(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """messages (JSON text) -> flat, validated events with the hash of their message."""
    hashed = messages.withColumn("_message_hash", F.sha2(F.coalesce(F.col(value_col), F.lit("")), 256))
    return validate_events(flatten_events(parse_messages(hashed, value_col)))
