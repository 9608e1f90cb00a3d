"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.session import reliable_checkpoint


def dense_rank_ids(df: DataFrame, col: str, id_col: str, num_partitions: int | None = None) -> DataFrame:
    """(col, id_col): 1-based dense rank of every distinct non-null ``col`` value.

    No task sees the whole set. It is range-partitioned once and written with
    a reliable ``checkpoint()`` (to ``spark.checkpoint.dir``), so every later read sees the same
    partition of each value; a recomputed range shuffle may sample other bounds. Values are
    numbered inside each partition and shifted by the number of values in all lower
    partitions; the only single-task step works on one row per partition.
    """
    distinct = df.select(col).where(F.col(col).isNotNull()).distinct()
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = reliable_checkpoint(distinct.repartitionByRange(n, col).withColumn("_part", F.spark_partition_id()))
    local = ranged.withColumn("_pos", F.row_number().over(Window.partitionBy("_part").orderBy(col)))
    # one row per range partition: bounded by n, never by the data
    offsets = (ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_offset", F.coalesce(
                   F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0))))
    return (local.join(F.broadcast(offsets.select("_part", "_offset")), "_part")
            .select(col, (F.col("_offset") + F.col("_pos")).cast("bigint").alias(id_col)))
