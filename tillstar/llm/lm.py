"""Language-model scores of whole documents, beside a unigram baseline.

1. Words of the training documents are counted over the whole corpus: a task counts its own words, the
   counts are packed by hash bucket and summed bucket by bucket. The head of the counts, a bounded number of words, goes
   back to the tasks; every other word's count is looked up by a join on the buckets.
2. A gated recurrent model (``gru``) over the most frequent words learns from every training document once,
   in rounds. In a round each task trains from the same parameters on its documents, and the results are
   averaged by the words seen, in two steps of bounded fan-in.
3. All documents are scored, the state carried through the whole text. A word that the model does not name
   has the probability of the rare class times its smoothed share of the rare counts, so a text's
   probability is whole: shares of all rare words and of one unseen word sum to 1.

Rare words of the tail travel as packed pairs (word hash, row number) to their bucket, meet the counts, and go on
to the row's bucket as sums.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm import gru
from tillstar.llm.common import Memo, cut, hash_memo, held_out, n_partitions, run_folder, runs, steps, table

FOLDS = 10
ROUNDS = 3
# Words whose counts every task gets.
HEAD = 1 << 17
# Words that a task holds before it trains on or scores them; distinct words before it sends its counts.
POOL_WORDS = 4 << 20
POOL_COUNTS = 2 << 20
END = b"\n"  # the end of a text, which no word can be


def sum_by_key(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = runs(keys)
    return keys[first], *(np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values)


def pack_by(bucket: np.ndarray, *arrays: np.ndarray) -> tuple[np.ndarray, list[list[bytes]]]:
    """One packed row per bucket."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    first = runs(bucket)
    ends = np.append(first[1:], len(bucket))
    return bucket[first], [[a[order[i:j]].tobytes() for i, j in zip(first, ends, strict=True)] for a in arrays]


def count_words(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, held = hash_memo(), []
        end = memo[END]

        def merged():
            return sum_by_key(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))

        def flush():
            keys, n = merged()
            bucket, (k, c) = pack_by((keys % np.uint64(buckets)).astype(np.int32), keys, n)
            return pa.record_batch([pa.array(bucket), pa.array(k, pa.binary()), pa.array(c, pa.binary())], ["bucket", "keys", "counts"])

        for part in steps(batches):
            words = [w for t in part.column("text").cast(pa.binary()).to_pylist() if t for w in t.lower().split()]
            flat = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
            keys, n = np.unique(flat, return_counts=True)
            held += [(keys, n), (np.array([end], np.uint64), np.array([part.num_rows]))]
            if sum(len(h[0]) for h in held) > POOL_COUNTS:
                held = [merged()]
                if len(held[0][0]) > POOL_COUNTS // 2:
                    yield flush()
                    held = []
        if held:
            yield flush()
    return run


def sum_buckets(head: int):
    """Rows sorted by bucket: one row per bucket with its counts, and its ``head`` most frequent words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, counts = None, [], []

        def done():
            k, c = sum_by_key(np.concatenate(keys), np.concatenate(counts))
            top = np.lexsort((k, -c))[:head]
            return pa.record_batch([pa.array([now], pa.int32()), pa.array([k.tobytes()]), pa.array([c.tobytes()]), pa.array([int(c.sum())]), pa.array([len(k)]),
                                    pa.array([k[top].tobytes()]), pa.array([c[top].tobytes()])],
                                   ["bucket", "keys", "counts", "n", "v", "head_keys", "head_counts"])
        for batch in batches:
            for r, b in enumerate(batch.column("bucket").to_pylist()):
                if b != now and keys:
                    yield done()
                    keys, counts = [], []
                now = b
                keys.append(np.frombuffer(batch.column("keys")[r].as_buffer(), np.uint64))
                counts.append(np.frombuffer(batch.column("counts")[r].as_buffer(), np.int64))
        if keys:
            yield done()
    return run


class Vocabulary:
    """The head's words by falling count; the first ones are the model's."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, n: int, v: int):
        order = np.lexsort((keys, -counts))
        self.keys, self.counts = keys[order], counts[order]
        self.n, self.v = n, v
        named = self.counts[:gru.WORDS]
        self.rare = n - int(named.sum())
        self.base = np.log10(n + 0.1 * (v + 1))
        self.rare_base = np.log10(self.rare + 0.1 * (v - len(named) + 1))

    def memo(self, most: int | None = None) -> Memo:
        """word -> rank among the head's first ``most`` words, -1 for others."""
        hashed = hash_memo().make
        place = {k: i for i, k in enumerate(self.keys[:most].tolist())}
        return Memo(lambda w: place.get(hashed(w), -1))


def ranks(part: pa.RecordBatch, memo: Memo) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(words with an end after each text, their ranks, the texts' lengths)."""
    texts = [t.lower().split() if t else [] for t in part.column("text").cast(pa.binary()).to_pylist()]
    words = [w for t in texts for w in (*t, END)]
    return words, np.fromiter(map(memo.__getitem__, words), np.int32, len(words)), np.array([len(t) + 1 for t in texts], np.int64)


def model_ids(rank: np.ndarray) -> np.ndarray:
    return np.where((rank < 0) | (rank >= gru.WORDS), gru.RARE, rank).astype(np.int16)


def train_round(vocabulary: Vocabulary, flat: np.ndarray):
    """One row per task: the parameters times the words seen, and those words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, trainer = vocabulary.memo(gru.WORDS), gru.Trainer(flat)
        ids, lengths, held, seen = [], [], 0, 0
        for part in steps(batches):
            _, rank, n = ranks(part, memo)
            ids.append(model_ids(rank))
            lengths.append(n)
            held += len(rank)
            if held >= POOL_WORDS:
                trainer.learn(np.concatenate(ids), np.concatenate(lengths))
                ids, lengths, held, seen = [], [], 0, seen + held
        if held:
            trainer.learn(np.concatenate(ids), np.concatenate(lengths))
            seen += held
        if seen:
            yield pa.record_batch([pa.array([float(seen)]), pa.array([(trainer.flat.astype(np.float64) * seen).tobytes()])], ["weight", "flat"])
    return run


def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    weight, total = 0.0, None
    for batch in batches:
        for r in range(batch.num_rows):
            part = np.frombuffer(batch.column("flat")[r].as_buffer(), np.float64)
            total = part.copy() if total is None else total + part
            weight += batch.column("weight")[r].as_py()
    if total is not None:
        yield pa.record_batch([pa.array([weight]), pa.array([total.tobytes()])], ["weight", "flat"])


def score_rows(vocabulary: Vocabulary, flat: np.ndarray, buckets: int):
    """A row per document from its head words and the model; packed (word hash, row) pairs of the other words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        memo, hashed = vocabulary.memo(), hash_memo()
        next_row = TaskContext.get().partitionId() << 32
        log_count = np.log10(vocabulary.counts + 0.1)
        pool: list = []
        held = 0

        def flush():
            nonlocal next_row
            doc_ids, rank, lengths, tail_keys, tail_at = (np.concatenate(x) if k else pa.concat_arrays(x) for k, x in enumerate(zip(*pool, strict=True)))
            owner = np.repeat(np.arange(len(lengths)), lengths)
            rows = next_row + np.arange(len(lengths))
            next_row += len(lengths)
            known = rank >= 0
            logs = np.where(known, log_count[np.maximum(rank, 0)] if len(log_count) else 0.0, 0.0)
            outside = rank >= gru.WORDS
            per_doc = lambda w: np.bincount(owner, weights=w, minlength=len(lengths))
            n_rare = per_doc(~known | outside)
            model = gru.score(flat, model_ids(rank), lengths) / np.log(10) + per_doc(np.where(outside, logs, 0)) - n_rare * vocabulary.rare_base
            base = per_doc(logs) - lengths * vocabulary.base
            n = len(lengths)
            yield pa.RecordBatch.from_arrays([pa.array(rows), doc_ids, pa.array(lengths), pa.array(per_doc(known).astype(np.int64)), pa.array(base), pa.array(model),
                                              pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], NAMES)
            if len(tail_keys):
                # tail_at counts tokens from the start of its step; steps were put end to end
                bucket, (k, r) = pack_by((tail_keys % np.uint64(buckets)).astype(np.int32), tail_keys, rows[owner[tail_at]])
                m = len(bucket)
                yield pa.RecordBatch.from_arrays([pa.nulls(m, pa.int64())] * 4 + [pa.nulls(m, pa.float64())] * 2 + [pa.array(bucket), pa.array(k, pa.binary()), pa.array(r, pa.binary())], NAMES)

        for part in steps(batches):
            words, rank, lengths = ranks(part, memo)
            tail = np.flatnonzero(rank < 0)
            keys = np.fromiter((hashed[words[i]] for i in tail.tolist()), np.uint64, len(tail))
            pool.append((part.column("doc_id"), rank, lengths, keys, tail + held))
            held += len(rank)
            if held >= POOL_WORDS:
                yield from flush()
                pool, held = [], 0
        if pool:
            yield from flush()
    return run


NAMES = ["row", "doc_id", "n_tokens", "n_known", "base", "model", "bucket", "keys", "rows"]
SCORED = "row bigint, doc_id bigint, n_tokens bigint, n_known bigint, base double, model double, bucket int, keys binary, rows binary"


def look_up(row_buckets: int):
    """Rows sorted by bucket, counts first: per document row, the sum of log10(count + 0.1) and the known words.

    What a task has found is summed by row before it goes on, packed by the row's bucket.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, counts = None, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        found, held = [], 0

        def flush():
            rows, logs, known = sum_by_key(*(np.concatenate(x) for x in zip(*found, strict=True)))
            bucket, (a, s, n) = pack_by((rows % row_buckets).astype(np.int32), rows, logs, known)
            return pa.record_batch([pa.array(bucket), pa.array(a, pa.binary()), pa.array(s, pa.binary()), pa.array(n, pa.binary())], ["bucket", "rows", "logs", "known"])

        for batch in batches:
            for r, b in enumerate(batch.column("bucket").to_pylist()):
                k = np.frombuffer(batch.column("keys")[r].as_buffer(), np.uint64)
                if b != now:
                    now, keys, counts = b, np.zeros(0, np.uint64), np.zeros(0, np.int64)
                if batch.column("counts")[r].is_valid:
                    keys, counts = k, np.frombuffer(batch.column("counts")[r].as_buffer(), np.int64)
                    continue
                c = np.zeros(len(k), np.int64)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
                    c = np.where(keys[at] == k, counts[at], 0)
                found.append((np.frombuffer(batch.column("rows")[r].as_buffer(), np.int64), np.log10(c + 0.1), (c > 0).astype(np.int64)))
                held += len(k)
                if held >= POOL_COUNTS:
                    yield flush()
                    found, held = [], 0
        if found:
            yield flush()
    return run


def sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: one row per document row."""
    now, held = None, []

    def done():
        rows, logs, known = sum_by_key(*(np.concatenate(x) for x in zip(*held, strict=True)))
        return pa.record_batch([pa.array(rows), pa.array(logs), pa.array(known)], ["row", "tail", "tail_known"])
    for batch in batches:
        for r, b in enumerate(batch.column("bucket").to_pylist()):
            if b != now and held:
                yield done()
                held = []
            now = b
            held.append(tuple(np.frombuffer(batch.column(c)[r].as_buffer(), t) for c, t in (("rows", np.int64), ("logs", np.float64), ("known", np.int64))))
    if held:
        yield done()


def vocabulary_of(docs: DataFrame, folder: str, buckets: int, head: int) -> tuple[DataFrame, Vocabulary]:
    spark = docs.sparkSession
    n = n_partitions(spark)
    packed = docs.where(~held_out(F.col("doc_id"), FOLDS)).select("text").mapInArrow(count_words(buckets), "bucket int, keys binary, counts binary")
    counts = cut(packed.repartition(n, "bucket").sortWithinPartitions("bucket")
                 .mapInArrow(sum_buckets(-(-head // buckets)), "bucket int, keys binary, counts binary, n bigint, v bigint, head_keys binary, head_counts binary"), folder, "counts")
    total, kinds = counts.agg(F.sum("n"), F.sum("v")).first()
    tops = counts.select("head_keys", "head_counts").toArrow()  # about ``head`` words in all
    read = lambda c, t: np.concatenate([np.zeros(0, t), *(np.frombuffer(x.as_buffer(), t) for x in tops.column(c))])
    return counts.select("bucket", "keys", "counts"), Vocabulary(read("head_keys", np.uint64), read("head_counts", np.int64), total or 0, kinds or 0)


def train(docs: DataFrame, vocabulary: Vocabulary, rounds: int, seed: int) -> np.ndarray:
    spark = docs.sparkSession
    flat = gru.start(vocabulary.counts[:gru.WORDS].astype(np.float64), float(vocabulary.rare), seed)
    learning = docs.where(~held_out(F.col("doc_id"), FOLDS))
    for k in range(rounds):
        part = learning.where(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == k).select("text")
        ways = part.mapInArrow(train_round(vocabulary, flat), "weight double, flat binary")
        some = ways.repartition(max(4, math.isqrt(n_partitions(spark)))).mapInArrow(fold, "weight double, flat binary")
        one = some.repartition(1).mapInArrow(fold, "weight double, flat binary").collect()
        if one:
            flat = (np.frombuffer(one[0]["flat"], np.float64) / one[0]["weight"]).astype(np.float32)
    return flat


def score(docs: DataFrame, rounds: int = ROUNDS, head: int = HEAD, seed: int = 1) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    A null text is the empty one: a single end. A null doc_id counts as the empty text in the split.
    Rows that repeat each count and each give a row; other columns are not read. Without training rows every
    word is unseen and both scores are 0. No rows give no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    folder, n = run_folder(spark, "lm"), n_partitions(spark)
    buckets = 4 * n
    counts, vocabulary = vocabulary_of(docs, folder, buckets, head)
    flat = train(docs, vocabulary, rounds, seed)
    scored = cut(docs.mapInArrow(score_rows(vocabulary, flat, buckets), SCORED), folder, "scored")
    asked = scored.where("bucket is not null").select("bucket", "keys", F.lit(None).cast("binary").alias("counts"), "rows", F.lit(1).alias("kind"))
    known = counts.select("bucket", "keys", "counts", F.lit(None).cast("binary").alias("rows"), F.lit(0).alias("kind"))
    met = known.unionAll(asked).repartition(n, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(look_up(n), "bucket int, rows binary, logs binary, known binary")
    tails = met.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(sum_rows, "row bigint, tail double, tail_known bigint")
    tail = F.coalesce("tail", F.lit(0.0))
    return (scored.where("row is not null").join(tails, "row", "left")
            .select("doc_id", held_out(F.col("doc_id"), FOLDS).alias("held_out"), "n_tokens",
                    (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"), F.lit(vocabulary.n).cast("bigint").alias("train_tokens"),
                    (F.col("base") + tail).alias("base_score"), (F.col("model") + tail).alias("score")))


def op1_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
