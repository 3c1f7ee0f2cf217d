"""Silver tables stored by municipality.

The fact, the municipal goals, the municipality dimension and the scores are written
with the same ``bucketBy(n, id_municipio)`` and sorted inside their buckets.  Spark
then joins them, and computes windows per municipality, without moving a row: the
one exchange of the fact is the one that writes it.

A bucketed table is known to the catalog, not to its folder, so these are tables of
a database with their files under ``root``; writing an entity again replaces both.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from letrado.plans.lazy import LazyTables

KEY = "id_municipio"
#: sorted by, inside a bucket; entities not named here have no municipality and are stored as they are
BUCKETED = {"indicador_alfabetizacao": [KEY, "ano"], "meta_municipio": [KEY, "ano"], "municipios": [KEY], "alunos": [KEY, "ano"]}


class BucketedSilver:
    def __init__(self, spark: SparkSession, root: str, prefix: str = "silver", buckets: int | None = None):
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix
        self.buckets = buckets or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def name(self, entity: str) -> str:
        return f"{self.prefix}_{entity}"

    def write(self, entity: str, df: DataFrame) -> DataFrame:
        """Store an entity; the table that was written."""
        w = df
        if entity in BUCKETED:      # one file a bucket: rows are dealt by the bucket key before the write
            w = df.repartition(self.buckets, KEY)
        w = w.write.mode("overwrite").format("parquet").option("path", f"{self.root}/{entity}")
        if entity in BUCKETED:
            w = w.bucketBy(self.buckets, KEY).sortBy(*BUCKETED[entity])
        w.saveAsTable(self.name(entity))
        return self.spark.table(self.name(entity))

    def write_all(self, silver: Mapping[str, DataFrame]) -> LazyTables:
        for entity in silver:
            self.write(entity, silver[entity])
        return self.tables(list(silver))

    def tables(self, entities) -> LazyTables:
        return LazyTables({e: (lambda e=e: self.spark.table(self.name(e))) for e in entities})

    def drop(self, entities) -> None:
        """Forget the tables; their files stay."""
        for e in entities:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(e)}")
