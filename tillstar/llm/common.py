"""What the operators share: reading, scratch tables, word splitting, connected components.

Words are runs of bytes outside ``\\x20 \\x09-\\x0D``; only ``A-Z`` is lower-cased. Both are what
``bytes.lower`` and ``bytes.split`` do, so a text is split as UTF-8 bytes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.session import scratch_root

WORD = r"[^\x20\x09-\x0D]+"
# Rows of one step inside a task. A step's arrays are dropped before the next one.
STEP_ROWS = 512
STEP_BYTES = 8 << 20
# Entries of a per-task dictionary (word -> hash or ids); a full one starts afresh.
CACHE_ENTRIES = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared checkpoint folder; Spark's writers create it."""
    return f"{scratch_root(spark)}/llm/{label}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, folder: str, name: str, **options) -> DataFrame:
    """Write ``df`` below ``folder`` and read it back: computed once, kept when executors are lost."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column, modulus: int) -> Column:
    """crc32 of doc_id as text, modulo ``modulus``, is 0. A null doc_id reads as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == 0


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def steps(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of the batches of at most STEP_ROWS rows and about STEP_BYTES of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = int(np.searchsorted(ends, before + STEP_BYTES, side="right"))
            to = max(at + 1, min(to, at + STEP_ROWS, batch.num_rows))
            yield batch.slice(at, to - at)
            at = to


class Memo(dict):
    """word -> value, made on first use. Emptied when it holds ``most`` words."""

    def __init__(self, make, most: int = CACHE_ENTRIES):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, word):
        if len(self) >= self.most:
            self.clear()
        value = self[word] = self.make(word)
        return value


def hash_memo() -> Memo:
    return Memo(xxhash.xxh64_intdigest)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (multiply and xor-shift)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD1B54A32D192ED03)
    return x ^ (x >> np.uint64(32))


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Start of each run of equal values."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))


def free(df: DataFrame, label: str) -> str:
    """A column name that ``df`` does not have, in any case of letters."""
    name, taken = f"__{label}", {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def hashable(df: DataFrame) -> list[Column]:
    """The columns in a form that hashes take: those that hold maps as JSON text."""
    return [F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() or "variant" in f.dataType.simpleString() else F.col(f"`{f.name}`")
            for f in df.schema.fields]


def fingerprint(df: DataFrame) -> tuple:
    row = df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*df.columns)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, folder: str, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for every node of an undirected edge list, the smallest node that links reach.

    Large-star and small-star steps alternate until the edges stop changing: every node is hooked to
    the smallest node it sees, so a chain halves with each round and a hub's neighbours stay one row
    each. The smallest neighbour is a partially aggregated minimum; the joins on it are plain
    equi joins whose hot side Spark can split. Each round is written to the shared folder.
    """
    e = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e = cut(e, folder, "edges-0")
    state = fingerprint(e)
    n = 0
    while state[0]:
        n += 1
        sym = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sym.join(low, "u").where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.distinct(), folder, f"large-{n}")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = cut(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct(), folder, f"edges-{n}")
        now = fingerprint(nxt)
        e = nxt
        if now == state:
            break
        state = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
