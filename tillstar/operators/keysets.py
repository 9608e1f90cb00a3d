"""Exact key sets as bitmaps, kept beside versioned tables: C1 on append, C2 of a batch.

A key set has one bitmap of 32,768 bits for each range of so many integer keys that occurs, stored in partitions
of 1,024 ranges. A batch is compared with the ranges it names, so what is read depends on the batch, not on the table:
at most 4 KB for each range that the batch touches. A key set knows the version of its table it takes account of and
reads only what later versions wrote, so a run lost in between is caught up by the next one.

Keys are BIGINT. NULL keys are in no set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.operators import versions
from tillstar.operators.upsert import CHANGE, KEPT
from tillstar.operators.versions import Layout
from tillstar.session import reliable_checkpoint

RANGES = Layout(("part",))
PER_PART = 1024


def bitmaps(df: DataFrame, key: str) -> DataFrame:
    """(part, range, bits, n): the keys of ``df`` and how many rows carry them, one row a range."""
    keys = df.select(F.col(key).cast("bigint").alias("k")).where("k is not null")
    return (keys.groupBy(F.bitmap_bucket_number("k").alias("range"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("k")).alias("bits"), F.count(F.lit(1)).alias("n"))
            .select(_part("range"), "range", "bits", "n"))


def _part(column: str) -> Column:
    return F.floor(F.col(column) / F.lit(PER_PART)).cast("bigint").alias("part")


def has_bit(bits: Column, key: Column) -> Column:
    """Whether the bitmap of a key's range holds the key."""
    at = F.bitmap_bit_position(key)
    byte = F.conv(F.hex(F.substring(bits, (F.call_function("div", at, F.lit(8)) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1, F.lit(False))


def name_of(table: str, key: str) -> str:
    return f"{table}__keys_{key}"


def sync(spark: SparkSession, table: str, key: str) -> str:
    """Bring the key set of a versioned table to its current version. Returns the key set's table."""
    keys, now = name_of(table, key), versions.current(spark, table)
    seen = versions.followed(spark, keys).get("table")
    if seen == now:
        return keys
    steps = versions.since(spark, table, seen) if seen is not None else None
    if steps is None or any(r["kind"] not in ("append", "upsert") for rows in steps for r in rows):
        versions.replace(spark, keys, bitmaps(versions.read(spark, table), key).drop("n"), RANGES, follows={"table": now})
        return keys
    new = None
    for rows in steps:
        for folder in sorted({versions.data_folder(r["folder"], r["spec"]) for r in rows if r["fresh"] and r["folder"]}):
            part = spark.read.parquet(folder)
            part = (part.where(F.col(CHANGE) != KEPT) if CHANGE in part.columns else part).select(F.col(key).cast("bigint").alias("k"))
            new = part if new is None else new.unionAll(part)
    if new is None:
        new = spark.createDataFrame([], "k bigint")
    delta = reliable_checkpoint(bitmaps(new, "k").drop("n"))
    merged = lambda target: target.unionByName(delta).groupBy("part", "range").agg(F.bitmap_or_agg("bits").alias("bits")).select(*target.columns)
    versions.rewrite(spark, keys, delta, merged, RANGES, follows={"table": now})
    return keys


def _touched(spark: SparkSession, keys: str, parts: DataFrame) -> DataFrame:
    """The stored bitmaps of the parts that ``parts`` names: one value a partition is collected."""
    values = [r["part"] for r in parts.select("part").distinct().collect()]
    return spark.table(keys).where(F.col("part").isin(values)) if values else spark.table(keys).limit(0)


def lacking(spark: SparkSession, keys: str, rows: DataFrame, column: str) -> DataFrame:
    """(key, n_rows): keys of ``rows[column]`` that are not in the key set. NULL passes. No read of the table itself."""
    named = reliable_checkpoint(rows.select(F.col(column).cast("bigint").alias("key")).where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n_rows")))
    named = named.withColumn("range", F.bitmap_bucket_number("key")).withColumn("part", _part("range"))
    return named.join(_touched(spark, keys, named).drop("part"), "range", "left").where(~has_bit(F.col("bits"), F.col("key"))).select("key", "n_rows")


def present(spark: SparkSession, keys: str, rows: DataFrame, column: str) -> DataFrame:
    """(key): keys of ``rows[column]`` that are in the key set, e.g. parents to delete that children still name."""
    named = reliable_checkpoint(rows.select(F.col(column).cast("bigint").alias("key")).where("key is not null").distinct())
    named = named.withColumn("range", F.bitmap_bucket_number("key")).withColumn("part", _part("range"))
    return named.join(_touched(spark, keys, named).drop("part"), "range").where(has_bit(F.col("bits"), F.col("key"))).select("key")


def check_appendable(spark: SparkSession, keys: str, batch: DataFrame, key: str) -> None:
    """Fails if a key of ``batch`` is NULL, occurs twice in it, or is in the key set already.

    Exact: the bits of stored and new bitmaps together are as many as both have on their own, or a key is repeated."""
    if batch.where(F.col(key).isNull()).limit(1).count():
        raise ValueError(f"primary key violation: NULL {key}")
    new = reliable_checkpoint(bitmaps(batch, key))
    stored = _touched(spark, keys, new).select("range", "bits", F.bitmap_count("bits").alias("n"))
    both = stored.unionByName(new.select("range", "bits", "n")).groupBy("range").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("bits"), F.sum("n").alias("n"))
    wrong = both.where("bits < n").agg(F.sum(F.col("n") - F.col("bits")).alias("again")).first()["again"]
    if wrong:
        raise ValueError(f"primary key violation: {wrong} rows repeat a {key}")


def append_keyed(spark: SparkSession, table: str, df: DataFrame, key: str, batch_id: str) -> bool:
    """K2 for a table with a primary key: a batch that repeats a stored key, or one of its own, is rejected whole, as the
    INSERT would be; one that was appended before (``batch_id``) adds nothing. Returns whether rows were added."""
    if versions.current(spark, table) and versions.has_batch(spark, table, batch_id):
        return False
    batch = reliable_checkpoint(df)
    if versions.current(spark, table):
        check_appendable(spark, sync(spark, table, key), batch, key)
    else:
        empty = name_of(table, key)
        versions.replace(spark, empty, bitmaps(df.limit(0), key).drop("n"), RANGES, follows={"table": 0})
        check_appendable(spark, empty, batch, key)
    added = versions.append_once(spark, table, batch, batch_id)
    sync(spark, table, key)
    return added


def orphans(spark: SparkSession, checks: Sequence[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """(constraint_name, orphan_keys, orphan_rows): C2 of a batch, for (name, rows, column, key set of the parent)."""
    out = None
    for name, rows, column, keys in checks:
        bad = lacking(spark, keys, rows, column).agg(F.count(F.lit(1)).alias("orphan_keys"), F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("orphan_rows"))
        bad = bad.select(F.lit(name).alias("constraint_name"), "orphan_keys", "orphan_rows")
        out = bad if out is None else out.unionAll(bad)
    return out
