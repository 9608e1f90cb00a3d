"""Loading into catalog tables (K1, K2, K3, K4) and reading them back.

* replace (K1): ``mode("overwrite")``;
* append (K2): ``mode("append")``; the re-run-safe form overwrites only the partitions
  present in the new data (``partitionOverwriteMode=dynamic``);
* upsert (K3): the merged table is written to a staging table first and swapped in only
  after that write succeeded, so a failed job leaves the old table whole and a retried job
  starts from it again. A table is never overwritten while it is being read.

Tables live in databases created at a location below the shared scratch or warehouse folder.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.operators.upsert import upsert
from tillstar.schemas import SPECS, TableSpec, ddl
from tillstar.session import reliable_checkpoint


def create_layer(spark: SparkSession, database: str, location: str | None = None) -> None:
    """K4: ``CREATE SCHEMA``; idempotent."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")


def conform(df: DataFrame, table: str, enforce: bool = True, ranges: bool = True) -> DataFrame:
    """Cast and order the columns as the declared table (K4 types, P3 implicit casts).

    With ``enforce``, the declared NOT NULL (and primary key) columns and VARCHAR(n) lengths are
    checked row by row and a violation fails the job, as the table's DDL rejects the statement
    (a codegen'd ``raise_error``, no extra pass). A declared DECIMAL(p,s) column is rounded to its scale and a value
    beyond its range fails; it is stored as DOUBLE. Without ``ranges`` it is stored as it is."""
    spec = SPECS.get(table)
    if spec is None:
        return df
    required = set(spec.not_null) | set(spec.primary_key)
    cols = []
    for f in spec.schema.fields:
        c = F.col(f.name).cast(f.dataType)
        if enforce and f.name in spec.max_length:
            n = spec.max_length[f.name]
            c = F.when(F.length(c) > n, F.raise_error(F.lit(f"{table}.{f.name}: value longer than VARCHAR({n})"))
                       ).otherwise(c)
        if enforce and ranges and f.name in spec.decimal:
            kind = "decimal({},{})".format(*spec.decimal[f.name])
            fits = F.col(f.name).try_cast(kind)
            c = F.when(F.col(f.name).isNotNull() & fits.isNull(), F.raise_error(F.lit(f"{table}.{f.name}: value beyond {kind.upper()}"))
                       .cast(f.dataType)).otherwise(fits.cast(f.dataType))
        if enforce and f.name in required:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"{table}.{f.name}: NULL in a NOT NULL column"))).otherwise(c)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def create_declared(spark: SparkSession, table: str, spec: TableSpec) -> None:
    """K4: ``CREATE TABLE`` with the declared types. Spark's own write checks then reject texts longer than VARCHAR(n)
    and numbers beyond DECIMAL(p,s). NOT NULL is not kept by Spark's file tables: ``insert_declared`` checks it."""
    spark.sql(f"CREATE TABLE {table} ({ddl(spec)}) USING parquet")


def insert_declared(df: DataFrame, table: str, spec: TableSpec) -> None:
    """Rows into a declared table; all or none. NULLs in key and NOT NULL columns fail the job as the DDL would."""
    required = set(spec.not_null) | set(spec.primary_key)
    checked = [F.when(F.col(f.name).isNull(), F.raise_error(F.lit(f"{table}.{f.name}: NULL in a NOT NULL column")).cast(df.schema[f.name].dataType))
               .otherwise(F.col(f.name)).alias(f.name) if f.name in required else F.col(f.name) for f in spec.schema.fields]
    df.select(*checked).write.insertInto(table)


def _for_partitioned_write(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one partition value brought together before a partitioned write, in files of
    about ``spark.sql.adaptive.advisoryPartitionSizeInBytes``: AQE splits a large partition value
    over several tasks and packs small ones together (REBALANCE), instead of every task writing
    a small file into every partition or one task writing a whole month."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def replace(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """K1: drop and rewrite."""
    w = _for_partitioned_write(df, partition_by).write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(table)


def append(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """K2: plain append (a re-run adds the rows again, as ``INSERT ... SELECT`` does)."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return replace(df, table, partition_by)
    _for_partitioned_write(df.select(*spark.table(table).columns), partition_by).write.mode("append") \
        .insertInto(table)


def overwrite_partitions(df: DataFrame, table: str, partition_by: Sequence[str]) -> None:
    """K2, re-run safe: replace only the partitions (e.g. days) present in ``df``."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return replace(df, table, partition_by)
    # ``insertInto`` takes the mode from the session, not from a writer option
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        _for_partitioned_write(df.select(*spark.table(table).columns), partition_by).write.mode("overwrite") \
            .insertInto(table)
    finally:
        spark.conf.set(key, before)


def swap_in(spark: SparkSession, staging: str, table: str) -> None:
    """Make the fully written ``staging`` table the current ``table``.

    Another session that read ``table`` before the swap (e.g. the driver session of a stream
    whose micro-batches swap) must ``REFRESH TABLE`` before reading it again."""
    if spark.catalog.tableExists(table):
        spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {staging} RENAME TO {table}")
    # the new table reuses the old location: drop cached file listings of it
    spark.catalog.refreshTable(table)


def _stagings(spark: SparkSession, table: str) -> list[str]:
    """Staging copies of ``table`` left by earlier runs, oldest first (names carry the time)."""
    db, name = table.rsplit(".", 1) if "." in table else ("default", table)
    prefix = f"{name}__staging_"
    return [f"{db}.{t.name}" for t in sorted(spark.catalog.listTables(db), key=lambda t: t.name)
            if t.name.startswith(prefix)]


def recover(spark: SparkSession, table: str) -> None:
    """Finish or clean up an interrupted swap before a new write.

    A staging table is registered only once fully written. If the run died after dropping the
    table and before renaming the staging copy, the newest staging copy becomes the table;
    staging copies of a run that died earlier, while the table is intact, are dropped."""
    stagings = _stagings(spark, table)
    if stagings and not spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {stagings[-1]} RENAME TO {table}")
        spark.catalog.refreshTable(table)
        stagings = stagings[:-1]
    for st in stagings:
        spark.sql(f"DROP TABLE IF EXISTS {st}")


def upsert_table(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str],
                 update_cols: Sequence[str]) -> None:
    """K3 against a stored table: merge, write to staging, swap. Re-runnable after a failure at
    any point (see ``recover``)."""
    recover(spark, table)
    exists = spark.catalog.tableExists(table)
    target = spark.table(table) if exists else spark.createDataFrame([], source.schema)
    merged = upsert(target, source, keys, update_cols)
    if not exists:
        return replace(merged, table)
    staging = f"{table}__staging_{time.time_ns():020d}_{uuid.uuid4().hex[:6]}"
    replace(merged, staging)
    swap_in(spark, staging, table)


def upsert_partitions(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str],
                      update_cols: Sequence[str], partition_by: Sequence[str], prune: bool = True) -> None:
    """K3 for a large table partitioned by columns that are a function of the key (they never
    change for a key, e.g. a key range, or the month of a date key). Partitions are replaced
    with dynamic partition overwrite: new files are staged by the commit protocol and moved in
    only when every task has finished, and a re-run after a failure gives the same table
    (applying a batch twice equals applying it once).

    ``prune`` (incremental batches): the batch is checkpointed once (it is read twice), and the target
    rows of the partitions it touches are found by a semi join with their distinct values, so only those
    partitions are merged and replaced, however many they are. Nothing is collected. A NULL partition
    value fails the job: the columns are a function of a key that is never NULL.
    Without ``prune`` (a full rebuild, where the batch touches every partition): the whole
    target is merged with the batch, computed once, and every partition is rewritten."""
    partition_by = list(partition_by)
    for c in partition_by:
        source = source.withColumn(c, F.coalesce(F.col(c), F.raise_error(F.lit(f"{table}.{c}: NULL partition value"))
                                                 .cast(source.schema[c].dataType)))
    if not spark.catalog.tableExists(table):
        merged = upsert(spark.createDataFrame([], source.schema), source, keys, update_cols)
        return replace(merged, table, partition_by)
    target = spark.table(table)
    batch = source
    if prune:
        batch = reliable_checkpoint(source)
        target = target.join(batch.select(*partition_by).distinct(), partition_by, "left_semi")
    merged = upsert(target.select(*spark.table(table).columns), batch, keys, update_cols)
    overwrite_partitions(merged, table, partition_by)
