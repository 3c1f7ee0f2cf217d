"""Wide-to-long, tolerant projection and null filling."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letrado.functions.scalar import safe_double

# Fixed prefix of the wide yearly goal columns (meta_alfabetizacao_YYYY).
GOAL_PREFIX = "meta_alfabetizacao_"
_YEAR_COL = re.compile(r"^" + GOAL_PREFIX + r"\d{4}$")


def year_columns(df: DataFrame) -> list[str]:
    return sorted(c for c in df.columns if _YEAR_COL.match(c))


def unpivot_years(df: DataFrame, ids: Sequence[str], value_name: str) -> DataFrame:
    """``meta_alfabetizacao_YYYY`` columns -> rows (ids..., ano, value).

    The year is the last four characters of the column name; values that are
    NULL, no number or NaN are dropped (as SQL ``UNPIVOT`` does with NULL;
    ``DataFrame.unpivot`` keeps it).
    """
    cols = year_columns(df)
    if not cols:
        raise ValueError("no meta_alfabetizacao_YYYY columns to unpivot")
    long = df.select(*ids, *[safe_double(c).alias(c) for c in cols]).unpivot(
        list(ids), cols, "ano_meta", value_name)
    return (long.where(F.col(value_name).isNotNull())
                .select(*ids,
                        F.substring("ano_meta", -4, 4).cast("int").alias("ano"),
                        F.col(value_name)))


def tolerant_select(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order."""
    present = set(df.columns)
    return df.select(*[c for c in cols if c in present])


def fill_missing(df: DataFrame, rules: Mapping[str, object]) -> DataFrame:
    """Fill NULLs by column; absent columns and ``None`` defaults are skipped."""
    present = set(df.columns)
    use = {k: v for k, v in rules.items() if k in present and v is not None}
    return df.fillna(use) if use else df
