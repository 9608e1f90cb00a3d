"""Continuous ingest of one raw source with Structured Streaming.

The batch job replaces each raw table from the full file list. The streaming form picks up
new files of a source folder as they land and merges each micro-batch into the raw table:
the last row per id inside the batch (file name, split, row order), then an upsert by id, so a
later file overrides an earlier one exactly as in the concatenated batch read.

Progress lives in the checkpoint folder; every micro-batch is an idempotent upsert into a versioned table
(``operators.versions``): it rewrites the key ranges it names, next to the old ones, and becomes visible whole, so a
batch replayed after a failure leaves the same table, and the cost of a batch does not follow the size of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstar.operators import versions
from tillstar.operators.clean import RULES, clean
from tillstar.plans.warehouse import RAW_LAYOUT, raw_rows
from tillstar.schemas import RAW
from tillstar.sources.files import _timestamp_text, with_read_position

STREAM_FORMATS = ("csv", "json_records", "parquet")


def read_stream(spark: SparkSession, name: str, fmt: str, folder: str, max_files_per_trigger: int | None = None
                ) -> DataFrame:
    """Streaming rows of source ``name`` with their file metadata in ``_meta``."""
    from pyspark.sql import types as T

    schema = RAW[name]
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    cols = [F.col(c) for c in schema.fieldNames()]
    if fmt == "csv":
        full = T.StructType([T.StructField("_index", T.LongType())] + list(schema.fields))
        raw = r.schema(full).option("header", True).option("mode", "FAILFAST").csv(folder)
    elif fmt == "json_records":
        # timestamps as ISO text or epoch milliseconds, as the batch reader accepts them
        ts = {f.name for f in schema.fields if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType))}
        text = T.StructType([T.StructField(f.name, T.StringType()) if f.name in ts else f for f in schema.fields])
        raw = r.schema(text).option("mode", "FAILFAST").json(folder)
        cols = [_timestamp_text(F.col(c), schema[c].dataType).alias(c) if c in ts else F.col(c)
                for c in schema.fieldNames()]
    elif fmt == "parquet":
        raw = r.schema(schema).parquet(folder)
    else:
        raise ValueError(f"streaming format must be one of {STREAM_FORMATS}")
    # the file metadata is taken in the projection right on the file source
    return raw.select(*cols, F.col("_metadata").alias("_meta"))


def merge_batch(name: str, table: str):
    """foreachBatch function: keep-last within the batch, then upsert by id into ``table``."""
    keys = list(RULES[name].dedup_keys) or ["id"]
    update = [f.name for f in RAW[name].fields if f.name not in keys]

    def run(batch: DataFrame, batch_id: int) -> None:
        positioned = with_read_position(batch, [], meta="_meta").drop("_meta")
        rows = clean(name, positioned)
        versions.upsert_versioned(batch.sparkSession, table, raw_rows(name, rows), keys, update, RAW_LAYOUT)
    return run


def start_ingest(spark: SparkSession, name: str, fmt: str, folder: str, table: str, checkpoint: str,
                 available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream. ``available_now``: process what has landed, then stop (scheduled
    runs); otherwise keep running with the default trigger."""
    w = (read_stream(spark, name, fmt, folder, max_files_per_trigger).writeStream
         .foreachBatch(merge_batch(name, table)).option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
