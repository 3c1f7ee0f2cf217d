"""Deterministic de-duplication on a key.

``row_number() = 1`` over the key with an explicit, total order.  Catalyst
turns this into a partial ``WindowGroupLimit`` below the shuffle, so every map
task forwards at most one row per key: a key holding a third of all rows costs
one row per map task in the exchange, not a third of the data in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols: Sequence, descending: bool) -> list[Column]:
    out = []
    for c in cols:
        col = F.col(c) if isinstance(c, str) else c
        out.append(col.desc_nulls_last() if descending else col.asc_nulls_last())
    return out


def keep_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence,
                tie_breakers: Sequence | None = None, descending: bool = True) -> DataFrame:
    """Keep one row per ``keys``: the greatest by ``order_by`` (NULLs lose).

    ``tie_breakers`` defaults to every remaining column, so the survivor never
    depends on file or partition order.
    """
    named = {c for c in order_by if isinstance(c, str)}
    if tie_breakers is None:
        tie_breakers = [c for c in df.columns if c not in keys and c not in named]
    w = Window.partitionBy(*keys).orderBy(*_order(list(order_by) + list(tie_breakers), descending))
    return (df.withColumn("__rn", F.row_number().over(w))
              .where(F.col("__rn") == 1)
              .drop("__rn"))


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence,
               tie_breakers: Sequence | None = None) -> DataFrame:
    """Keep the smallest row per key (the ``keep="first"`` option)."""
    return keep_latest(df, keys, order_by, tie_breakers, descending=False)
