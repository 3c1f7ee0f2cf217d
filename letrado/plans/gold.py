"""Gold layer: the four analytical tables.

Joins to the dimensions are plain equi-joins; Catalyst broadcasts a side only
when its estimated size is under ``autoBroadcastJoinThreshold`` and AQE
re-checks with the real shuffle sizes, so nothing is broadcast on faith.
Group-level aggregates use partial (map-side) aggregation.  Municipalities are
counted distinct, exactly: Catalyst first aggregates by (group, municipality),
which spreads a hot year over all of its municipalities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from letrado.functions.scalar import round2, status_meta
from letrado.plans.lazy import LazyTables

INDICADOR_MUNICIPIO_COLS = [
    "id_municipio", "nome", "sigla_uf", "id_uf", "nome_uf", "ano", "indicador_alfabetizacao",
    "quantidade_matriculas", "meta_municipio", "meta_nacional", "gap_vs_meta_municipio",
    "gap_vs_meta_nacional", "status_meta_municipio", "meta_atingida",
]


def goals_by_year(meta_mun: DataFrame) -> DataFrame:
    """(id_municipio, year -> goal); one entry a year, as silver goals are unique by (id_municipio, ano)."""
    return meta_mun.groupBy("id_municipio").agg(
        F.map_from_entries(F.collect_list(F.struct("ano", "meta_municipio"))).alias("_metas"))


def build_indicador_municipio(ind: DataFrame, mun: DataFrame, ufs: DataFrame,
                              meta_mun: DataFrame, meta_br: DataFrame) -> DataFrame:
    """The fact meets its dimensions on the municipality alone: names come with their state's, goals as one map of
    years a municipality.  A fact that lies by municipality is therefore not moved again for these joins, nor for
    the lags of the feature table."""
    m = (mun.select("id_municipio", F.col("nome_municipio").alias("nome"), "sigla_uf", "id_uf")
            .join(ufs.select("id_uf", "nome_uf"), "id_uf", "left"))
    mb = meta_br.select("ano", "meta_nacional")
    df = (ind.join(goals_by_year(meta_mun), "id_municipio", "left")
             .join(m, "id_municipio", "left")
             .withColumn("meta_municipio", F.try_element_at("_metas", F.col("ano")))
             .join(mb, "ano", "left"))
    ind_v = F.col("indicador_alfabetizacao")
    return df.select(
        *[F.col(c) for c in INDICADOR_MUNICIPIO_COLS[:10]],
        round2(ind_v - F.col("meta_municipio")).alias("gap_vs_meta_municipio"),
        round2(ind_v - F.col("meta_nacional")).alias("gap_vs_meta_nacional"),
        status_meta(ind_v, F.col("meta_municipio")).alias("status_meta_municipio"),
        F.col("meta_atingida"),
    )


def _pct(k, n):
    return round2(F.col(k) / F.nullif(F.col(n), F.lit(0)) * 100)


def _uf_aggregate(ind: DataFrame, mun: DataFrame, ufs: DataFrame, round_extremes: bool) -> DataFrame:
    j = (ind.select("id_municipio", "ano", "indicador_alfabetizacao", "quantidade_matriculas",
                    "meta_atingida")
            .join(mun.select("id_municipio", "id_uf", "sigla_uf"), "id_municipio", "left")
            .join(ufs.select("id_uf", "nome_uf"), "id_uf", "left")
            .where(F.col("id_uf").isNotNull()))
    ext = round2 if round_extremes else (lambda c: c)
    v = F.col("indicador_alfabetizacao")
    return j.groupBy("id_uf", "sigla_uf", "nome_uf", "ano").agg(
        round2(F.avg(v)).alias("indicador_medio"),
        ext(F.min(v)).alias("indicador_min"),
        ext(F.max(v)).alias("indicador_max"),
        F.count_distinct("id_municipio").alias("total_municipios"),
        F.count_if(F.col("meta_atingida")).alias("municipios_meta_atingida"),
        F.coalesce(F.sum("quantidade_matriculas"), F.lit(0).cast("bigint")).alias("matriculas_total"),
    )


def build_evolucao_uf(ind: DataFrame, mun: DataFrame, ufs: DataFrame, meta_uf: DataFrame,
                      first_fill: float | None = None) -> DataFrame:
    a = _uf_aggregate(ind, mun, ufs, round_extremes=True)
    a = a.join(meta_uf.select("id_uf", "ano", "meta_uf"), ["id_uf", "ano"], "left")
    w = Window.partitionBy("id_uf").orderBy(F.col("ano").asc_nulls_last())
    yoy = round2(F.col("indicador_medio") - F.lag("indicador_medio", 1).over(w))
    if first_fill is not None:
        yoy = F.coalesce(yoy, F.lit(float(first_fill)))
    return a.select(
        "id_uf", "sigla_uf", "nome_uf", "ano", "indicador_medio", "indicador_min", "indicador_max",
        "total_municipios", "matriculas_total", "municipios_meta_atingida", "meta_uf",
        _pct("municipios_meta_atingida", "total_municipios").alias("pct_municipios_meta_atingida"),
        yoy.alias("variacao_yoy"),
    )


def build_evolucao_uf_export(ind: DataFrame, mun: DataFrame, ufs: DataFrame) -> DataFrame:
    """The CSV export form: raw extremes, no state goal, first-year change 0.0."""
    a = _uf_aggregate(ind, mun, ufs, round_extremes=False)
    w = Window.partitionBy("id_uf").orderBy(F.col("ano").asc_nulls_last())
    yoy = F.coalesce(round2(F.col("indicador_medio") - F.lag("indicador_medio", 1).over(w)),
                     F.lit(0.0))
    return a.select(
        "id_uf", "sigla_uf", "nome_uf", "ano", "indicador_medio", "indicador_min", "indicador_max",
        "total_municipios", "municipios_meta_atingida", "matriculas_total",
        _pct("municipios_meta_atingida", "total_municipios").alias("pct_municipios_meta_atingida"),
        yoy.alias("variacao_yoy"),
    )


def _national_aggregate(ind: DataFrame) -> DataFrame:
    v = F.col("indicador_alfabetizacao")
    return ind.groupBy("ano").agg(
        F.avg(v).alias("_media"),
        F.count_distinct("id_municipio").alias("total_municipios"),
        F.count_if(F.col("meta_atingida")).alias("municipios_meta_atingida"),
        F.coalesce(F.sum("quantidade_matriculas"), F.lit(0).cast("bigint")).alias("total_matriculas"),
    )


def build_painel_nacional(ind: DataFrame, meta_br: DataFrame, gap_from_rounded: bool = False) -> DataFrame:
    a = _national_aggregate(ind).join(meta_br.select("ano", "meta_nacional"), "ano", "left")
    media = round2("_media")
    base = media if gap_from_rounded else F.col("_media")
    return a.select(
        "ano",
        media.alias("indicador_medio_nacional"),
        "total_municipios", "municipios_meta_atingida", "total_matriculas", "meta_nacional",
        _pct("municipios_meta_atingida", "total_municipios").alias("pct_municipios_alfabetizados"),
        round2(base - F.col("meta_nacional")).alias("gap_meta"),
    )


def status_counts(indicador_municipio: DataFrame) -> DataFrame:
    return (indicador_municipio.groupBy("ano", "status_meta_municipio")
            .agg(F.count(F.lit(1)).alias("n_municipios")))


def build_gold(silver) -> LazyTables:
    """The gold tables over a silver mapping; each is built on first use."""
    return LazyTables({
        "indicador_municipio": lambda: build_indicador_municipio(
            silver["indicador_alfabetizacao"], silver["municipios"], silver["ufs"],
            silver["meta_municipio"], silver["meta_brasil"]),
        "evolucao_uf": lambda: build_evolucao_uf(
            silver["indicador_alfabetizacao"], silver["municipios"], silver["ufs"], silver["meta_uf"]),
        "painel_nacional": lambda: build_painel_nacional(
            silver["indicador_alfabetizacao"], silver["meta_brasil"]),
    })
