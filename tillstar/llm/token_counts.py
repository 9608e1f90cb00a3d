"""Token counts through a digest cache.

The cache is a folder of parquet rows (digest, tokenizer, n_tokens). A document's content is its
UTF-8 text with null as the empty text; its digest is SHA-256. Counts of digests that the cache
holds for this tokenizer version are joined to the documents; of the others, each distinct text is
encoded once and its count appended. Copies of one text collapse in the map-side half of an
aggregation by digest, so a text that a third of all rows repeat is shuffled once per map task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.bpe import Encoder, tokenizer_digest, tokenizer_path
from tillstar.llm.common import run_folder, steps, table

CACHE_SCHEMA = "digest binary, n_tokens bigint, tokenizer string"


def content(df: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, the text with null as empty, and its digest."""
    text = F.coalesce("text", F.lit(""))
    return df.select(*keep, text.alias("text"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))


def distinct_texts(df: DataFrame) -> DataFrame:
    """(digest, text): each text once. Grouping by digest has a map-side half, so copies meet early."""
    return content(df).groupBy("digest").agg(F.first("text").alias("text"))


def read_cache(spark, cache: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version; (digest, tokenizer) is unique whatever was appended."""
    if not has_rows(spark, cache):
        return spark.createDataFrame([], CACHE_SCHEMA).drop("tokenizer")
    return (spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer") == version)
            .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))


def has_rows(spark, folder: str) -> bool:
    """Whether a finished write has left the folder there (asked of the store that Spark uses)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def encode_counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for part in steps(batches):
            texts = part.column("text").to_pylist()
            counts = [len(encoder.ids(t)) // 4 for t in texts]
            yield pa.record_batch([part.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, cache: str, path: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row; misses are encoded and appended to ``cache``.

    Null text counts as empty (0 bytes, 0 tokens); a null doc_id stays null; repeated rows each give
    a row; columns beyond doc_id and text are not read, whatever their names; no rows give no rows.
    An append that a lost executor cut short leaves no rows, as the writer commits whole jobs; two
    jobs that append the same digest store equal counts, and reading takes one.
    """
    spark = docs.sparkSession
    path = path or tokenizer_path()
    version = tokenizer_digest(path)
    misses = distinct_texts(docs).join(read_cache(spark, cache, version), "digest", "left_anti")
    (misses.mapInArrow(encode_counts(path), "digest binary, n_tokens bigint")
     .withColumn("tokenizer", F.lit(version)).write.mode("append").parquet(cache))
    keyed = content(docs, "doc_id").select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "digest")
    return keyed.join(read_cache(spark, cache, version), "digest").select("doc_id", "n_bytes", "n_tokens")


def op9_token_counts(spark, sf_dir: str) -> DataFrame:
    counts = count_tokens(table(spark, sf_dir, "documents"), run_folder(spark, "token-cache"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))
