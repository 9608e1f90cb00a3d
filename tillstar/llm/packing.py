"""Best-fit packing of tokenised documents by minimum bin slack.

Only the histogram of piece lengths (at most ``capacity`` rows) reaches the driver. There each bin
is filled by a bitset subset-sum over the lengths still available: bit ``s`` of a Python integer
tells whether some choice of lengths sums to ``s``. The fullest choice is a pattern; it is removed as
many times as the stock allows, which exhausts at least one length. So there are at most ``capacity``
patterns of at most 63 distinct lengths each, whatever the number of documents: that bounds what is
sent back to the tasks. Pieces of one length are numbered 0, 1, ... without gathering them anywhere
(counts per written block give each block its first number), and a number picks its place in a pattern.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.bpe import Encoder, tokenizer_path
from tillstar.llm.common import cut, run_folder, steps, table

CAPACITY = 2048
END = b"\0\0\0\0"
PIECES = "doc_id bigint, piece int, start bigint, length int, ids_crc32 bigint, block bigint"
# Rows of a block: the numbering of equal lengths counts them block by block.
BLOCK_ROWS = 1 << 16


def cut_pieces(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece: all full but the first, which may be shorter."""
    first = length % capacity or min(length, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


def pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        base = TaskContext.get().partitionId() << 32
        encoder, made = Encoder(path), 0
        for part in steps(batches):
            rows, texts = [], part.column("text").to_pylist()
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                ids = encoder.ids(text) + END
                view = memoryview(ids)
                for k, (start, length) in enumerate(cut_pieces(len(ids) // 4, capacity)):
                    rows.append((doc_id, k, start, length, zlib.crc32(view[4 * start:4 * (start + length)]), base + (made + len(rows)) // BLOCK_ROWS))
            made += len(rows)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "block"])
    return run


@dataclass
class Pattern:
    lengths: list[tuple[int, int]]  # (length, how often), longest first
    bins: int


def fullest(stock: dict[int, int], order: list[int], capacity: int) -> list[tuple[int, int]]:
    """The longest length and the choice of others that leaves least room: (length, times), longest first.

    ``order`` is the available lengths, longest first. Each length enters the bitset in shares of 1, 2,
    4, ... so that any number of it can be chosen; the walk back through the shares reads off the choice.
    """
    seed = order[0]
    room = capacity - seed
    mask = (1 << (room + 1)) - 1
    reach, before = 1, []
    for length in order:
        left = min(stock[length] - (length == seed), room // length)
        share = 1
        while left > 0:
            share = min(share, left)
            before.append((length, share, reach))
            reach |= (reach << (length * share)) & mask
            left -= share
            share *= 2
        if reach >> room & 1:
            break
    rest = reach.bit_length() - 1
    chosen = {seed: 1}
    for length, share, had in reversed(before):
        if not had >> rest & 1:
            rest -= length * share
            chosen[length] = chosen.get(length, 0) + share
    return sorted(chosen.items(), reverse=True)


def minimum_bin_slack(stock: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that use up the stock of lengths. Each removal exhausts at least one length."""
    stock = {k: v for k, v in stock.items() if v}
    order = sorted(stock, reverse=True)
    patterns = []
    while order:
        chosen = fullest(stock, order, capacity)
        bins = min(stock[length] // times for length, times in chosen)
        for length, times in chosen:
            stock[length] -= times * bins
        order = [x for x in order if stock[x]]
        patterns.append(Pattern(chosen, bins))
    return patterns


def places(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """Where the n-th piece of a length goes, by (length, first number of the range)."""
    rows, used, first_bin = [], {}, 0
    for p in patterns:
        offset = 0
        for length, times in p.lengths:
            first = used.get(length, 0)
            rows.append((length, first, times, first_bin, offset))
            used[length] = first + times * p.bins
            offset += length * times
        first_bin += p.bins
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "times", "bin", "offset"), cols, strict=True))


def place(where: dict[str, np.ndarray]):
    # one sorted key for (length, first number): numbers stay below 2^50
    key = where["length"] * (1 << 50) + where["first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy().astype(np.int64)
            number = batch.column("number").to_numpy()
            at = np.searchsorted(key, length * (1 << 50) + number, side="right") - 1
            k = number - where["first"][at]
            times = where["times"][at]
            keep = [batch.column(c) for c in ("doc_id", "piece", "start", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(length), pa.array(where["bin"][at] + k // times), pa.array(where["offset"][at] + k % times * length)],
                ["doc_id", "piece", "start", "ids_crc32", "length", "sequence_id", "offset"])
    return run


def numbered(rows: DataFrame) -> DataFrame:
    """``number``: 0, 1, ... among the rows of equal length.

    Rows are numbered inside (length, block), a group of at most BLOCK_ROWS rows, and shifted by the
    rows of that length in earlier blocks. The running total has one row per length and block.
    """
    local = rows.withColumn("n", F.row_number().over(Window.partitionBy("block", "length").orderBy("doc_id", "piece", "ids_crc32")) - 1)
    counts = rows.groupBy("block", "length").agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("block", "length", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("shift"))
    return local.join(shift, ["block", "length"]).withColumn("number", F.col("shift") + F.col("n"))


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and then id 0; a null text is the empty one, a single id 0. Null
    doc_ids and repeated rows are packed like others, each row by itself; other columns are not read.
    No rows give no rows.
    """
    spark = docs.sparkSession
    folder = run_folder(spark, "packing")
    found = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(pieces(path or tokenizer_path(), capacity), PIECES)
    rows = cut(found, folder, "pieces")
    stock = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}  # at most ``capacity`` rows
    where = places(minimum_bin_slack(stock, capacity))
    return numbered(rows).select("doc_id", "piece", "start", "ids_crc32", "length", "number").mapInArrow(
        place(where), "doc_id bigint, piece int, start bigint, ids_crc32 bigint, length bigint, sequence_id bigint, offset bigint")


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
