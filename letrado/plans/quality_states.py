"""Incremental data quality: check states kept per day, merged instead of recomputed.

All metrics of a check are sums over rows, but for the counts of distinct keys.  A
day's state is its one row of sums and the hashes of its distinct keys.  The report
over several days adds the sums and counts the keys of the days' states together:
the rows of earlier days are not read again, and the result is the report over all
rows.  Writing a day again replaces its state.

Keys are told apart by 128 bits of hash, NULLs included.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from letrado.plans import quality

KEYS_SCHEMA = "metric string, h1 long, h2 long, day string"


def _key_hash(keys: Sequence[str], seed: int) -> Column:
    # a hash skips NULLs, so where they stand is hashed too
    return F.xxhash64(F.lit(seed), *[x for k in keys for x in (F.col(k), F.col(k).isNull())])


class QualityStates:
    def __init__(self, spark: SparkSession, path: str, rules: Mapping[tuple[str, str], dict] = quality.ENTITY_RULES):
        self.spark, self.path, self.rules = spark, path.rstrip("/"), rules

    def _at(self, part: str, layer: str, entity: str) -> str:
        return f"{self.path}/{part}/{layer}.{entity}"

    def add(self, day: str, layer: str, entity: str, df: DataFrame) -> None:
        """Store the state of one day's rows of an entity: one pass for the sums, one for the distinct keys."""
        built, _ = quality.compile_checks(df, entity, layer, self.rules[layer, entity])
        sums = df.agg(F.count(F.lit(1)).alias("n_rows"), *quality.metrics_of(built, distinct=False))
        sums.write.mode("overwrite").parquet(f"{self._at('sums', layer, entity)}/day={day}")
        for i, c in built:
            for k, keys in c.distinct.items():
                (df.select(_key_hash(keys, 0).alias("h1"), _key_hash(keys, 1).alias("h2")).distinct()
                 .write.mode("overwrite").parquet(f"{self._at('keys', layer, entity)}/metric=c{i}_{k}/day={day}"))
        # what the checks are compiled on when the report is made: the day's columns, no rows
        df.limit(0).write.mode("overwrite").parquet(f"{self._at('columns', layer, entity)}/day={day}")

    def _read(self, part: str, layer: str, entity: str, days: Sequence[str] | None, schema: str | None = None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        df = reader.parquet(self._at(part, layer, entity))
        return df if days is None else df.where(F.col("day").cast("string").isin(list(days)))

    def entity_report(self, layer: str, entity: str, days: Sequence[str] | None = None) -> DataFrame:
        columns = self._read("columns", layer, entity, days).drop("day")
        built, failures = quality.compile_checks(columns, entity, layer, self.rules[layer, entity])
        sums = self._read("sums", layer, entity, days)
        names = [f"c{i}_{k}" for i, c in built for k in c.metrics]
        total = sums.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]) if names else self.spark.range(1)
        distinct = [f"c{i}_{k}" for i, c in built for k in c.distinct]
        if distinct:
            keys = self._read("keys", layer, entity, days, KEYS_SCHEMA).select("metric", "h1", "h2").distinct()
            counted = keys.agg(*[F.count_if(F.col("metric") == n).alias(n) for n in distinct])
            # two tables of one row each
            total = total.withColumn("_one", F.lit(1)).join(F.broadcast(counted.withColumn("_one", F.lit(1))), "_one").drop("_one")
        return quality.report_rows(total, built, failures, entity, layer)

    def report(self, days: Sequence[str] | None = None, consistency=(("gold", "indicador_municipio"),
                                                                     ("silver", "indicador_alfabetizacao"))) -> DataFrame:
        """The quality report over the stored days (all, if not named)."""
        parts, found = [], set()
        for layer, entity in self.rules:
            try:
                parts.append(self.entity_report(layer, entity, days))
                found.add((layer, entity))
            except AnalysisException as e:
                parts.append(quality.failed_row(self.spark, "arquivo_existente", entity, layer, f"unreadable={type(e).__name__}"))
        if consistency and found >= set(consistency):
            g, s = consistency
            none = F.lit(0).cast("bigint")
            both = (self._read("sums", *s, days).select(F.col("n_rows").alias("_s"), none.alias("_g"))
                    .unionByName(self._read("sums", *g, days).select(none.alias("_s"), F.col("n_rows").alias("_g"))))
            parts.append(quality.consistency_row(both, g[1]))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
