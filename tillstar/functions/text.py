"""String functions (F1 and text casts)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat_sql(*parts: Column | str) -> Column:
    """SQL-standard CONCAT as in the warehouse: a NULL part counts as empty text.

    Spark's ``concat`` returns NULL on any NULL part and ``concat_ws`` drops the separator
    with the NULL, so each part is coalesced instead.
    """
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def full_name(first: Column | str, last: Column | str) -> Column:
    return concat_sql(first, F.lit(" "), last)
