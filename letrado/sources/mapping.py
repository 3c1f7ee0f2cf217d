"""Bronze domain tables derived from the driver's test tables.

The test data holds no literacy data, so each domain source is defined as a
deterministic projection of a driver table (FIXTURES.md, part B).  Every rule
below is plain column arithmetic, so the bronze tables grow with the input
and the same definitions are written in SQL for the oracle.

Mapping rules (fixed values of the test mapping):
  ufs            <- nation:   id_uf = n_nationkey, sigla = n_name,
                              nome = ' são ' || lower(n_name) || ' '
  municipios     <- customer x nation: nome NULL when c_custkey % 50 = 0;
                              sigla_uf 'ZZ' (orphan) when c_custkey % 100 = 99,
                              else ' ' || lower(n_name)
  indicador      <- orders:   id = o_custkey, ano = year(o_orderdate),
                              taxa 'n/d' when o_orderkey % 97 = 0,
                              indicador = floor(o_totalprice / 50) / 100,
                              matriculas NULL when o_orderkey % 11 = 0 else o_orderkey % 1000
  alunos         <- lineitem: id_aluno = l_orderkey-l_linenumber, id_municipio = l_partkey,
                              proficiencia = 600 + (round(l_extendedprice*100) % 30000) / 100
  meta_municipio <- customer: wide 1995..2001, 40 + c_custkey % 20 + (Y - 1995);
                              no goal when c_custkey % 3 = 0; 2001 empty for even keys;
                              as text, 'n/d' when c_custkey % 13 = 0, 'NaN' when % 17 = 0;
                              ingested 2024-01-15, and when c_custkey % 5 = 0 once before,
                              on 2024-01-10, with goals that are 30 higher
  meta_uf        <- nation:   wide, 30 + n_nationkey + 2 (Y - 1995), ingested 2024-01-15,
                              and when n_nationkey % 3 = 0 before, on 2024-01-10, 20 higher
  meta_brasil    <- mean of the municipal goals per year (one wide row)
  events         <- events:   click/view -> INDICADOR_ATUALIZADO, purchase -> NOVA_MEDICAO,
                              signup -> META_REVISADA, error -> event without id_municipio;
                              ano = 1995 + event_id % 7, indicador = value, matriculas = props.k
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letrado.functions.scalar import round2, safe_double
from letrado.operators.reshape import GOAL_PREFIX
from letrado.plans.lazy import LazyTables
from letrado.sources.tables import read_table

# Goal years of the test mapping (the order years of the driver data).
GOAL_YEARS = tuple(range(1995, 2002))
FIRST_GOAL_YEAR = GOAL_YEARS[0]

# Event types of the stream and the driver event type each one comes from.
EVENT_TYPE_MAP = {
    "click": "INDICADOR_ATUALIZADO",
    "view": "INDICADOR_ATUALIZADO",
    "purchase": "NOVA_MEDICAO",
    "signup": "META_REVISADA",
    "error": "INDICADOR_ATUALIZADO",
}
EVENT_SOURCE_PREFIX = "evt_"


def bronze_ufs(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").cast("string").alias("id_uf"),
        F.col("n_name").alias("sigla"),
        F.concat(F.lit(" são "), F.lower("n_name"), F.lit(" ")).alias("nome"),
    )


def bronze_municipios(customer: DataFrame, nation: DataFrame) -> DataFrame:
    n = nation.select("n_nationkey", "n_name")
    c = customer.select("c_custkey", "c_name", "c_nationkey")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    return j.select(
        F.col("c_custkey").cast("string").alias("id_municipio"),
        F.when(F.col("c_custkey") % 50 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("c_name")).alias("nome"),
        F.when(F.col("c_custkey") % 100 == 99, F.lit("ZZ"))
         .otherwise(F.concat(F.lit(" "), F.lower("n_name"))).alias("sigla_uf"),
        F.col("c_nationkey").cast("string").alias("id_uf"),
    )


def bronze_indicador(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return orders.select(
        F.col("o_custkey").cast("string").alias("id_municipio"),
        F.year("o_orderdate").cast("int").alias("ano"),
        F.when(k % 97 == 0, F.lit("n/d")).otherwise(F.lit(None).cast("string"))
         .alias("taxa_alfabetizacao"),
        (F.floor(F.col("o_totalprice") / 50).cast("double") / F.lit(100.0))
         .alias("indicador_alfabetizacao"),
        F.when(k % 11 == 0, F.lit(None).cast("bigint")).otherwise(k % 1000)
         .cast("bigint").alias("quantidade_matriculas"),
        F.col("o_orderdate").alias("_ingestion_timestamp"),
        k.alias("_record_id"),
    )


def bronze_alunos(lineitem: DataFrame) -> DataFrame:
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return lineitem.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("id_aluno"),
        F.col("l_partkey").cast("string").alias("id_municipio"),
        F.year("l_shipdate").cast("int").alias("ano"),
        (F.lit(600.0) + (cents % 30000) / F.lit(100.0)).alias("proficiencia"),
        F.col("l_shipdate").alias("_ingestion_timestamp"),
    )


def _goal_col(y: int) -> str:
    return f"{GOAL_PREFIX}{y}"


def bronze_meta_municipio(customer: DataFrame) -> DataFrame:
    def goal(y: int) -> str:
        empty = "c_custkey % 3 = 0" + (" OR c_custkey % 2 = 0" if y == GOAL_YEARS[-1] else "")
        value = f"CAST(CAST(40 + c_custkey % 20 + {y - FIRST_GOAL_YEAR} + higher AS DOUBLE) AS STRING)"
        return (f"CASE WHEN {empty} THEN NULL WHEN c_custkey % 13 = 0 THEN 'n/d' WHEN c_custkey % 17 = 0 THEN 'NaN' "
                f"ELSE {value} END AS {_goal_col(y)}")
    return _revised(customer, "c_custkey % 5 = 0", 30).selectExpr(
        "CAST(c_custkey AS STRING) AS id_municipio", *[goal(y) for y in GOAL_YEARS], "_ingestion_timestamp")


def _revised(table: DataFrame, older: str, higher: int) -> DataFrame:
    """Every row as of its last ingestion, and the rows where ``older`` holds once more
    as of an earlier one (one scan: a generator, not a union)."""
    now = "named_struct('higher', 0, '_ingestion_timestamp', TIMESTAMP_NTZ'2024-01-15 00:00:00')"
    then = f"named_struct('higher', {higher}, '_ingestion_timestamp', TIMESTAMP_NTZ'2024-01-10 00:00:00')"
    return table.selectExpr("*", f"inline(CASE WHEN {older} THEN array({now}, {then}) ELSE array({now}) END)")


def bronze_meta_uf(nation: DataFrame) -> DataFrame:
    return _revised(nation, "n_nationkey % 3 = 0", 20).selectExpr(
        "concat(' ', lower(n_name)) AS sigla_uf",
        *[f"CAST(30 + n_nationkey + {2 * (y - FIRST_GOAL_YEAR)} + higher AS DOUBLE) AS {_goal_col(y)}"
          for y in GOAL_YEARS], "_ingestion_timestamp")


def bronze_meta_brasil(customer: DataFrame) -> DataFrame:
    """National goal per year = mean of the municipal goals (one wide row)."""
    wide = bronze_meta_municipio(customer)
    return wide.agg(*[round2(F.avg(safe_double(_goal_col(y)))).alias(_goal_col(y)) for y in GOAL_YEARS])


def _event_type(col) -> F.Column:
    e = None
    for src, dst in EVENT_TYPE_MAP.items():
        e = (F.when(col == src, F.lit(dst)) if e is None else e.when(col == src, F.lit(dst)))
    return e.otherwise(F.lit(None).cast("string"))


def stream_payloads(events: DataFrame) -> DataFrame:
    """events -> the typed event records a producer would publish."""
    et = F.col("event_type")
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        _event_type(et).alias("event_type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.struct(
            F.when(et == "error", F.lit(None).cast("string"))
             .otherwise(F.col("user_id").cast("string")).alias("id_municipio"),
            (F.lit(FIRST_GOAL_YEAR) + F.col("event_id") % 7).cast("int").alias("ano"),
            F.col("value").alias("indicador_alfabetizacao"),
            F.get_json_object("props", "$.k").try_cast("bigint").alias("quantidade_matriculas"),
            F.concat(F.lit(EVENT_SOURCE_PREFIX), et).alias("fonte"),
        ).alias("payload"),
    )


def stream_messages(events: DataFrame) -> DataFrame:
    """One JSON message body per event (the NDJSON line / message data)."""
    p = stream_payloads(events)
    return p.select(F.to_json(F.struct("event_id", "event_type", "timestamp", "payload"))
                    .alias("value"))


def bronze_entities(spark: SparkSession, sf_dir: str) -> LazyTables:
    """Entity catalogue: the seven batch extracts (built on first use)."""
    reads: dict[str, DataFrame] = {}

    def t(name: str) -> DataFrame:  # one scan definition per table and query
        if name not in reads:
            reads[name] = read_table(spark, sf_dir, name)
        return reads[name]

    return LazyTables({
        "ufs": lambda: bronze_ufs(t("nation")),
        "municipios": lambda: bronze_municipios(t("customer"), t("nation")),
        "indicador_alfabetizacao": lambda: bronze_indicador(t("orders")),
        "alunos": lambda: bronze_alunos(t("lineitem")),
        "meta_brasil": lambda: bronze_meta_brasil(t("customer")),
        "meta_uf": lambda: bronze_meta_uf(t("nation")),
        "meta_municipio": lambda: bronze_meta_municipio(t("customer")),
    })
