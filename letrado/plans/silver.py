"""Silver layer: typed, normalised, de-duplicated, referentially checked.

Each transform tells its ``probe`` the rows left after every step (input, key,
duplicates, value, reference); the job counts them while it writes.

Order inside every entity transform: cast per value (``try_cast``; a bad value
becomes NULL, never a job failure) -> de-duplicate on the entity key (latest
``_ingestion_timestamp`` wins, full tie-breaker) -> filter -> referential
integrity (``left_semi``) -> flags.  De-duplicating before the integrity join
means every key reaches the join at most once per year, whatever the skew of
the raw extract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letrado.functions.scalar import (
    MISSING_NAME, literate_flag, norm_text, safe_double, safe_long, target_flag,
)
from letrado.operators.dedup import keep_latest
from letrado.operators.integrity import referential_filter
from letrado.operators.reshape import unpivot_years, year_columns
from letrado.plans.lazy import LazyTables

# Steps of a transform, named by what they take out (the reject reasons), with the input and what is kept.
NO_KEY, NO_VALUE, DUPLICATE, ORPHAN, KEPT, INPUT = (
    "sem_chave", "sem_valor", "duplicada", "orfa", "mantidas", "entrada")


def unobserved(step: str, df: DataFrame, rows_each: int = 1) -> DataFrame:
    """The probe that looks at nothing."""
    return df


# Ordering columns a bronze row may carry (audit timestamp, then source sequence).
ORDER_COLS = ("_ingestion_timestamp", "_record_id")


def _order_cols(df: DataFrame) -> list[str]:
    return [c for c in ORDER_COLS if c in df.columns]


def _carry(df: DataFrame) -> list:
    return [F.col(c) for c in _order_cols(df)]


def _dedup(df: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    order = _order_cols(df)
    out = keep_latest(df, keys, order_by=order, tie_breakers=payload)
    return out.drop(*order)


def transform_ufs(bronze: DataFrame, probe=unobserved) -> DataFrame:
    df = probe(NO_KEY, probe(INPUT, bronze).where(F.col("id_uf").isNotNull())).select(
        F.col("id_uf").cast("string").alias("id_uf"),
        norm_text("sigla").alias("sigla_uf"),
        norm_text("nome").alias("nome_uf"),
        *_carry(bronze))
    return probe(DUPLICATE, _dedup(df, ["id_uf"], ["sigla_uf", "nome_uf"]))


MUNICIPIO_PAYLOAD = ["nome_municipio", "sigla_uf", "id_uf"]


def typed_municipios(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        F.col("id_municipio").cast("string").alias("id_municipio"),
        F.coalesce(norm_text("nome"), F.lit(MISSING_NAME)).alias("nome_municipio"),
        norm_text("sigla_uf").alias("sigla_uf"),
        F.col("id_uf").cast("string").alias("id_uf"),
        *_carry(bronze))


def prepare_municipios(bronze: DataFrame, probe=unobserved) -> DataFrame:
    """Typed, normalised, one row per id; before the state-code check."""
    df = typed_municipios(probe(NO_KEY, probe(INPUT, bronze).where(F.col("id_municipio").isNotNull())))
    return probe(DUPLICATE, _dedup(df, ["id_municipio"], MUNICIPIO_PAYLOAD))


def transform_municipios(bronze: DataFrame, ufs: DataFrame, probe=unobserved) -> DataFrame:
    return probe(ORPHAN, referential_filter(prepare_municipios(bronze, probe), ufs, "sigla_uf"))


def _indicator_value(bronze: DataFrame):
    parts = [safe_double(c) for c in ("taxa_alfabetizacao", "indicador_alfabetizacao")
             if c in bronze.columns]
    if not parts:
        raise ValueError("indicador bronze has neither taxa_alfabetizacao nor indicador_alfabetizacao")
    return F.coalesce(*parts) if len(parts) > 1 else parts[0]


def typed_measurements(bronze: DataFrame) -> DataFrame:
    """Every bronze row as a measurement; a year that is no number is NULL."""
    qm = (safe_long("quantidade_matriculas") if "quantidade_matriculas" in bronze.columns
          else F.lit(None).cast("bigint"))
    ts = (F.col("_ingestion_timestamp").cast("timestamp_ntz") if "_ingestion_timestamp" in bronze.columns
          else F.lit(None).cast("timestamp_ntz"))
    seq = (F.col("_record_id").cast("bigint") if "_record_id" in bronze.columns
           else F.lit(None).cast("bigint"))
    return bronze.select(
        F.col("id_municipio").cast("string").alias("id_municipio"),
        F.col("ano").try_cast("int").alias("ano"),
        _indicator_value(bronze).alias("indicador_alfabetizacao"),
        qm.alias("quantidade_matriculas"),
        F.lit(0).alias("_priority"),
        ts.alias("_order_ts"),
        seq.alias("_seq"),
        F.lit(None).cast("string").alias("_event_id"),
    )


def _batch_measurements(bronze: DataFrame, probe=unobserved) -> DataFrame:
    # the year is tested after the cast: text that is no year makes no key
    return probe(NO_KEY, typed_measurements(probe(INPUT, bronze)).where(
        F.col("id_municipio").isNotNull() & F.col("ano").isNotNull()))


def stream_measurements(events: DataFrame, event_types=None, skip_null: bool = True) -> DataFrame:
    """Flattened valid events -> rows that override batch rows of the same key."""
    ev = events.where(F.length(F.col("id_municipio")) > 0)
    if event_types:
        ev = ev.where(F.col("event_type").isin(list(event_types)))
    if skip_null:
        ev = ev.where(F.col("indicador_alfabetizacao").isNotNull())
    return ev.select(
        F.col("id_municipio").cast("string"),
        F.col("ano").try_cast("int"),
        F.col("indicador_alfabetizacao").cast("double"),
        F.col("quantidade_matriculas").cast("bigint"),
        F.lit(1).alias("_priority"),
        F.col("event_timestamp").cast("timestamp_ntz").alias("_order_ts"),
        F.lit(None).cast("bigint").alias("_seq"),
        F.col("event_id").cast("string").alias("_event_id"),
    )


INDICADOR_COLS = ["id_municipio", "ano", "indicador_alfabetizacao", "quantidade_matriculas",
                  "meta_atingida"]
LINEAGE_COLS = ["_priority", "_order_ts", "_seq", "_event_id"]
# Stored silver indicador is partitioned by (ano, _bucket): an upsert rewrites
# only the hash buckets its events touch, not whole years.
UPSERT_BUCKETS = 64


def bucket_of(col: str = "id_municipio", buckets: int = UPSERT_BUCKETS):
    return F.pmod(F.xxhash64(F.col(col)), F.lit(buckets)).cast("int")


MEASUREMENT_PAYLOAD = ["indicador_alfabetizacao", "quantidade_matriculas"]


def rank_measurements(rows: DataFrame) -> DataFrame:
    """One row per (id_municipio, ano): stream beats batch, then the newest
    event/ingestion time, then the source sequence / event id."""
    return keep_latest(rows, ["id_municipio", "ano"], order_by=LINEAGE_COLS, tie_breakers=MEASUREMENT_PAYLOAD)


STREAM_INPUT = "entrada_stream"


def prepare_indicador(bronze: DataFrame, stream: DataFrame | None = None, event_types=None,
                      skip_null: bool = True, probe=unobserved) -> DataFrame:
    """Batch (+ stream) rows ranked to one per key, NULL indicators dropped;
    before the municipality check."""
    rows = _batch_measurements(bronze, probe)
    if stream is not None:
        rows = rows.unionByName(probe(STREAM_INPUT, stream_measurements(stream, event_types, skip_null)))
    return probe(NO_VALUE, probe(DUPLICATE, rank_measurements(rows)).where(F.col("indicador_alfabetizacao").isNotNull()))


def finish_indicador(ranked: DataFrame, municipios: DataFrame, keep_lineage: bool = False, probe=unobserved) -> DataFrame:
    df = ranked.where(F.col("indicador_alfabetizacao").isNotNull())
    df = probe(ORPHAN, referential_filter(df, municipios, "id_municipio"))
    df = df.withColumn("meta_atingida", target_flag("indicador_alfabetizacao"))
    if not keep_lineage:
        return df.select(*INDICADOR_COLS)
    return df.select(*INDICADOR_COLS, *LINEAGE_COLS, bucket_of().alias("_bucket"))


def transform_indicador(bronze: DataFrame, municipios: DataFrame, stream: DataFrame | None = None,
                        event_types=None, skip_null: bool = True,
                        keep_lineage: bool = False, probe=unobserved) -> DataFrame:
    return finish_indicador(prepare_indicador(bronze, stream, event_types, skip_null, probe),
                            municipios, keep_lineage, probe)


ALUNO_PAYLOAD = ["proficiencia_saeb", "id_municipio"]


def typed_alunos(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        *([F.col("id_aluno").cast("string").alias("id_aluno")] if "id_aluno" in bronze.columns else []),
        F.col("ano").try_cast("int").alias("ano"),
        F.col("id_municipio").cast("string").alias("id_municipio"),
        safe_double("proficiencia").alias("proficiencia_saeb"),
        *_carry(bronze))


def ranked_alunos(bronze: DataFrame, probe=unobserved) -> DataFrame:
    """Typed, one row per (id_aluno, ano); a row without a year has no key."""
    df = probe(NO_KEY, typed_alunos(probe(INPUT, bronze)).where(F.col("ano").isNotNull()))
    if "id_aluno" in bronze.columns:
        df = _dedup(df, ["id_aluno", "ano"], ALUNO_PAYLOAD)
    else:
        df = df.drop(*_order_cols(df))
    return probe(DUPLICATE, df)


def prepare_alunos(bronze: DataFrame, probe=unobserved) -> DataFrame:
    """Ranked and scored; before the municipality check."""
    return probe(NO_VALUE, ranked_alunos(bronze, probe).where(F.col("proficiencia_saeb").isNotNull()))


def transform_alunos(bronze: DataFrame, municipios: DataFrame, probe=unobserved) -> DataFrame:
    df = probe(ORPHAN, referential_filter(prepare_alunos(bronze, probe), municipios, "id_municipio"))
    return df.withColumn("aluno_alfabetizado", literate_flag("proficiencia_saeb"))


def _long_goals(bronze: DataFrame, ids: list[str], value: str, probe=unobserved) -> DataFrame:
    """Accept the wide source (meta_alfabetizacao_YYYY) or an already long one.
    The audit columns come along: the latest ingestion of a goal wins."""
    ids = [*ids, *_order_cols(bronze)]
    years = year_columns(bronze)
    if years:       # a wide row counts as one row a year
        return probe(NO_VALUE, unpivot_years(probe(INPUT, bronze, len(years)), ids, value))
    src = value if value in bronze.columns else "meta"
    long = probe(INPUT, bronze).select(*ids, F.col("ano").try_cast("int").alias("ano"), safe_double(src).alias(value))
    return probe(NO_VALUE, long.where(F.col("ano").isNotNull() & F.col(value).isNotNull()))


def transform_meta_brasil(bronze: DataFrame, probe=unobserved) -> DataFrame:
    return probe(DUPLICATE, _dedup(_long_goals(bronze, [], "meta_nacional", probe), ["ano"], ["meta_nacional"]))


def prepare_meta_uf(bronze: DataFrame, probe=unobserved) -> DataFrame:
    """Long form with the normalised state code; before the state lookup."""
    return _long_goals(bronze, ["sigla_uf"], "meta_uf", probe).withColumn("sigla_uf", norm_text("sigla_uf"))


def transform_meta_uf(bronze: DataFrame, ufs: DataFrame, probe=unobserved) -> DataFrame:
    if "sigla_uf" in bronze.columns:
        df = prepare_meta_uf(bronze, probe)
        # look the state id up by its normalised code; unknown codes drop out
        df = df.join(ufs.select("id_uf", "sigla_uf"), "sigla_uf", "inner")
    else:
        df = _long_goals(bronze, ["id_uf"], "meta_uf", probe).withColumn("id_uf", F.col("id_uf").cast("string"))
        df = referential_filter(df, ufs, "id_uf").join(ufs.select("id_uf", "sigla_uf"), "id_uf", "left")
    df = probe(DUPLICATE, _dedup(probe(ORPHAN, df), ["id_uf", "ano"], ["meta_uf", "sigla_uf"]))
    return df.select("id_uf", "sigla_uf", "ano", "meta_uf")


def prepare_meta_municipio(bronze: DataFrame, probe=unobserved) -> DataFrame:
    df = _long_goals(bronze, ["id_municipio"], "meta_municipio", probe) \
        .withColumn("id_municipio", F.col("id_municipio").cast("string"))
    return probe(DUPLICATE, _dedup(df, ["id_municipio", "ano"], ["meta_municipio"]))


def transform_meta_municipio(bronze: DataFrame, municipios: DataFrame, probe=unobserved) -> DataFrame:
    df = probe(ORPHAN, referential_filter(prepare_meta_municipio(bronze, probe), municipios, "id_municipio"))
    return df.select("id_municipio", "ano", "meta_municipio")


#: the dimensions an entity is checked against
DIMENSIONS = {"municipios": ["ufs"], "meta_uf": ["ufs"], "indicador_alfabetizacao": ["municipios"], "alunos": ["municipios"],
              "meta_municipio": ["municipios"]}


def build_silver(bronze, stream: DataFrame | None = None, keep_lineage: bool = False, dims=None,
                 probe_of=lambda entity: unobserved) -> LazyTables:
    """All silver entities, dims first; each is built on first use.  ``dims`` (entity -> DataFrame) gives the states
    and municipalities that the others are checked against, where they are written already."""
    out: LazyTables
    ref = lambda e: out[e] if dims is None else dims(e)

    def ind():
        return transform_indicador(bronze["indicador_alfabetizacao"], ref("municipios"), stream,
                                   keep_lineage=keep_lineage, probe=probe_of("indicador_alfabetizacao"))

    out = LazyTables({
        "ufs": lambda: transform_ufs(bronze["ufs"], probe_of("ufs")),
        "municipios": lambda: transform_municipios(bronze["municipios"], ref("ufs"), probe_of("municipios")),
        "indicador_alfabetizacao": ind,
        "alunos": lambda: transform_alunos(bronze["alunos"], ref("municipios"), probe_of("alunos")),
        "meta_brasil": lambda: transform_meta_brasil(bronze["meta_brasil"], probe_of("meta_brasil")),
        "meta_uf": lambda: transform_meta_uf(bronze["meta_uf"], ref("ufs"), probe_of("meta_uf")),
        "meta_municipio": lambda: transform_meta_municipio(bronze["meta_municipio"], ref("municipios"),
                                                           probe_of("meta_municipio")),
    })
    return out
