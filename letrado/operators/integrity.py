"""Referential integrity: keep rows whose key exists in a reference table.

``left_semi`` never fans out when the reference has duplicate keys (an inner
join would) and NULL keys never match.  The orphans are the ``left_anti``
complement; both use the same join so they always partition the input.
When the reference is small Catalyst/AQE broadcast it (size checked at plan
and at run time); otherwise the sort-merge semi join is split by AQE's skew
handling when one key carries a large share of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ref_keys(ref: DataFrame, key: str, ref_key: str | None) -> DataFrame:
    ref_key = ref_key or key
    return ref.select(F.col(ref_key).alias(key)).where(F.col(key).isNotNull())


def referential_filter(df: DataFrame, ref: DataFrame, key: str,
                       ref_key: str | None = None) -> DataFrame:
    return df.join(_ref_keys(ref, key, ref_key), on=key, how="left_semi")


def orphans(df: DataFrame, ref: DataFrame, key: str, ref_key: str | None = None) -> DataFrame:
    return df.join(_ref_keys(ref, key, ref_key), on=key, how="left_anti")
