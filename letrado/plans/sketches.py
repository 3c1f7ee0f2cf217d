"""Distinct municipalities from mergeable sketches.

Gold counts municipalities exactly.  Where many levels are asked for (state, year,
nation, any selection of years), a sketch per (state, year) stored beside gold
answers them by merging sketches, without reading a municipality again.  The
estimate's relative standard error is about 1.04 / sqrt(2**LG_K); up to some
thousand values the sketch still holds them all and is exact but for hashing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 14
STANDARD_ERROR = 1.04 / 2 ** (LG_K / 2)
LEVELS = (("id_uf", "ano"), ("id_uf",), ("ano",), ())


def municipality_sketches(ind: DataFrame, mun: DataFrame) -> DataFrame:
    """(id_uf, ano, municipios): one sketch per state and year, partial aggregates before the shuffle."""
    states = mun.select("id_municipio", "id_uf")
    return (ind.select("id_municipio", "ano").join(states, "id_municipio", "left").where(F.col("id_uf").isNotNull())
            .groupBy("id_uf", "ano").agg(F.hll_sketch_agg("id_municipio", F.lit(LG_K)).alias("municipios")))


def estimate(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Estimated distinct municipalities per ``by``, merged from the stored sketches."""
    merged = sketches.groupBy(*by) if by else sketches.groupBy()
    return merged.agg(F.hll_sketch_estimate(F.hll_union_agg("municipios")).alias("n_estimate"))


def compare(sketches: DataFrame, ind: DataFrame, mun: DataFrame) -> DataFrame:
    """(id_uf, ano, n_exact, within_error) at every level; NULL stands for "all"."""
    rows = (ind.select("id_municipio", "ano").join(mun.select("id_municipio", "id_uf"), "id_municipio", "left")
            .where(F.col("id_uf").isNotNull()))
    kinds = {c: rows.schema[c].dataType for c in ("id_uf", "ano")}
    out = None
    for by in LEVELS:
        def level(df, value):
            return df.select(*[F.col(c) if c in by else F.lit(None).cast(kinds[c]).alias(c) for c in kinds], value)
        exact = level((rows.groupBy(*by) if by else rows.groupBy()).agg(F.count_distinct("id_municipio").alias("n_exact")), "n_exact")
        guess = level(estimate(sketches, by), "n_estimate").withColumnsRenamed({c: f"_{c}" for c in kinds})
        same = F.col("id_uf").eqNullSafe(F.col("_id_uf")) & F.col("ano").eqNullSafe(F.col("_ano"))
        off = F.abs(F.col("n_estimate") - F.col("n_exact"))
        both = exact.join(guess, same).select("id_uf", "ano", "n_exact", (off <= F.greatest(
            F.lit(1.0), F.col("n_exact") * F.lit(3 * STANDARD_ERROR))).alias("within_error"))
        out = both if out is None else out.unionByName(both)
    return out
