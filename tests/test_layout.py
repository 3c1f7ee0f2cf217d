"""Files laid out by an interleaved key: filters on either column skip files, by the files' own footers."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import rows
from letrado.sources import io

FILES = 16


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(64_000).select(
        F.concat(F.lit("S"), F.lpad((F.xxhash64("id") % 27 + 27).cast("string"), 2, "0")).alias("sigla_uf"),
        (2000 + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(25))).cast("int").alias("ano"), F.col("id").cast("string").alias("id_municipio"))


def footers(path, col):
    """(low, high) of every data file from its footer."""
    out = []
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = next(i for i in range(meta.num_columns) if meta.schema.column(i).name == col)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        out.append((min(s.min for s in stats), max(s.max for s in stats)))
    return out


def skipped(path, col, values):
    """Mean share of files that an equality filter skips."""
    bounds = footers(path, col)
    return sum(sum(not lo <= v <= hi for lo, hi in bounds) / len(bounds) for v in values) / len(values)


def test_either_filter_skips_files(spark, table, tmp_root):
    io.interleaved(table, ["sigla_uf", "ano"], FILES).write.parquet(f"{tmp_root}/z")
    (table.repartitionByRange(FILES, "sigla_uf", "ano", "id_municipio").sortWithinPartitions("sigla_uf", "ano")
          .write.parquet(f"{tmp_root}/plain"))
    states = [r[0] for r in table.select("sigla_uf").distinct().collect()]
    years = [r[0] for r in table.select("ano").distinct().collect()]
    z = (skipped(f"{tmp_root}/z", "sigla_uf", states), skipped(f"{tmp_root}/z", "ano", years))
    plain = (skipped(f"{tmp_root}/plain", "sigla_uf", states), skipped(f"{tmp_root}/plain", "ano", years))
    assert min(z) > 0.4, (z, plain)                         # a filter on either column skips files
    assert plain[0] > 0.8 and plain[1] < 0.3, (z, plain)    # the plain sort serves its first column only
    assert sorted(rows(spark.read.parquet(f"{tmp_root}/z"))) == sorted(rows(table))
    bounds = io.file_bounds(spark, f"{tmp_root}/z", ["ano"])
    assert sorted((r["low_ano"], r["high_ano"]) for r in bounds.collect()) == sorted(footers(f"{tmp_root}/z", "ano"))
    share = {r["value"]: r["skipped"] for r in io.skipped_share(bounds, "ano").collect()}
    assert all(abs(share[v] - skipped(f"{tmp_root}/z", "ano", [v])) < 1e-9 for v in share)


def test_layout_keeps_rows_of_hot_null_and_empty_columns(spark, tmp_root):
    odd = spark.createDataFrame([("A", None, str(i)) for i in range(300)] + [(None, 2000 + i % 3, "x") for i in range(5)],
                                "sigla_uf string, ano int, id_municipio string")
    io.interleaved(odd, ["sigla_uf", "ano"], 4).write.parquet(f"{tmp_root}/odd")
    assert sorted(rows(spark.read.parquet(f"{tmp_root}/odd")), key=str) == sorted(rows(odd), key=str)
    files = io.file_bounds(spark, f"{tmp_root}/odd", ["ano"]).collect()
    assert max(r["n_rows"] for r in files) < 200            # one hot key lies in several files
    assert io.interleaved(odd.where("false"), ["sigla_uf", "ano"]).count() == 0
