"""Keep-last de-duplication.

``drop_duplicates(subset=keys, keep='last')`` keeps, for every key, the row that comes last
in the concatenated input. On Spark "last" must be an explicit ordering: a version column
of the table, or the read position recorded by ``sources.files`` (file ordinal, split start,
row id).

Plan shape: ``row_number() = 1`` over ``partitionBy(keys)`` is planned as a partial
WindowGroupLimit before the shuffle and a final one after it, so each map task ships at most
one row per key. A hot key (a third of all rows) therefore reaches its reducer as at most one
row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.sources.files import READ_ORDER


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None,
              drop_order: bool = True) -> DataFrame:
    """One row per ``keys``: the greatest by ``order`` (default: the read position, whose
    columns are dropped from the result unless ``drop_order`` is False).

    Rows with NULL keys form one group per NULL pattern, as in pandas."""
    order = list(order) if order else list(READ_ORDER)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    w = Window.partitionBy(*keys).orderBy(*[c.desc() for c in order_cols])
    out = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    if drop_order:
        out = out.drop(*[c for c in READ_ORDER if c in out.columns])
    return out
