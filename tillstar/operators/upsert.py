"""Upsert with a column subset (K3): ``INSERT ... ON CONFLICT (keys) DO UPDATE SET <cols>``.

Semantics kept from the warehouse:
* a source row whose key exists in the target updates **only** ``update_cols``; the other
  columns keep the target's values;
* a new key is inserted with all source columns; target rows absent from the source stay;
* the source must be unique on the key and the key must not be NULL (C6): otherwise the
  job fails, as the statement would.

Plan: one full outer join on the key. The uniqueness check is a count over the same key
partitioning (``Window.partitionBy(keys)``), so the join reuses that shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def checked_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source`` with a failing expression guarding C6 (unique, non-NULL key)."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    guard = (F.when(null_key, F.raise_error(F.lit("upsert source has a NULL key")))
              .when(n > 1, F.raise_error(F.concat(F.lit("upsert source has a duplicate key: "),
                                                  F.to_json(F.struct(*keys)))))
              .otherwise(F.lit(True)))
    return source.withColumn("_s", guard)


def was(column: str) -> str:
    return f"_was_{column}"


# 0: a target row that the source does not name, 1: inserted, 2: updated.
CHANGE = "_change"
KEPT, INSERTED, UPDATED = 0, 1, 2


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
           remember: Sequence[str] = ()) -> DataFrame:
    """The target after the upsert, with the target's columns in the target's order.

    With ``remember``, the join also tells what it did: ``_change`` of each row, and the old values
    of these columns as ``_was_<column>`` where a row was updated."""
    keys = list(keys)
    cols = target.columns
    missing = [c for c in update_cols if c not in cols]
    if missing:
        raise ValueError(f"update columns not in target: {missing}")
    t = target.withColumn("_t", F.lit(True))
    s = checked_source(source.select(*[c for c in cols if c in source.columns]), keys)
    t_, s_ = t.alias("t"), s.alias("s")
    cond = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    j = t_.join(s_, cond, "full_outer")
    in_t, in_s = F.col("t._t").isNotNull(), F.col("s._s").isNotNull()
    out = []
    for c in cols:
        if c in keys:
            # the guard stands in the key, which every reader of the result evaluates
            e = F.when(F.coalesce(F.col("s._s"), F.lit(True)), F.when(in_t, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")))
        elif c in update_cols:
            e = F.when(in_s, F.col(f"s.{c}") if c in source.columns else F.lit(None)).otherwise(F.col(f"t.{c}"))
        else:
            e = F.when(in_t, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}") if c in source.columns else F.lit(None))
        out.append(e.cast(target.schema[c].dataType).alias(c))
    if remember:
        out.append(F.when(in_s & in_t, F.lit(UPDATED)).when(in_s, F.lit(INSERTED)).otherwise(F.lit(KEPT)).alias(CHANGE))
        out += [F.when(in_s & in_t, F.col(f"t.{c}")).alias(was(c)) for c in remember]
    return j.select(*out)


def merge_sql(table: str, source: str, columns: Sequence[str], keys: Sequence[str], update_cols: Sequence[str]) -> str:
    """The upsert as a ``MERGE INTO`` command, for tables of a catalog that merges rows itself."""
    on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    sets = ", ".join(f"t.`{c}` = s.`{c}`" for c in update_cols)
    matched = f" WHEN MATCHED THEN UPDATE SET {sets}" if update_cols else ""
    names, values = ", ".join(f"`{c}`" for c in columns), ", ".join(f"s.`{c}`" for c in columns)
    return f"MERGE INTO {table} AS t USING {source} AS s ON {on}{matched} WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"


def merges_rows(spark, table: str) -> bool:
    """Whether Spark can plan row-level commands on ``table``: it belongs to a catalog other than the session's own
    file tables, and that catalog's table accepts a MERGE (asked by EXPLAIN, which runs nothing)."""
    if table.count(".") < 2 or table.split(".")[0] == "spark_catalog":
        return False
    columns = spark.table(table).columns
    plan = spark.sql(f"EXPLAIN {merge_sql(table, f'(SELECT * FROM {table} WHERE false)', columns, columns[:1], [])}").first()[0]
    return "UNSUPPORTED" not in plan and "Error occurred" not in plan


def merge_into(source: DataFrame, table: str, keys: Sequence[str], update_cols: Sequence[str]) -> None:
    """K3 by the catalog's own row-level writes. The source is checked first (C6), as the join form does."""
    columns = [c for c in source.sparkSession.table(table).columns if c in source.columns]
    checked = checked_source(source.select(*columns), keys).where("_s").drop("_s")
    writer = checked.alias("s").mergeInto(table, F.expr(" AND ".join(f"{table}.`{k}` = s.`{k}`" for k in keys)))
    if update_cols:
        writer = writer.whenMatched().update({c: F.col(f"s.{c}") for c in update_cols})
    writer.whenNotMatched().insert({c: F.col(f"s.{c}") for c in columns}).merge()
