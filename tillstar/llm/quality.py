"""Quality from weak labels: overlapping heuristics vote, expectation-maximisation weighs them, a hashed scorer learns.

Each labeller votes good, bad or abstains on a document. Only the counts of vote patterns (at most
3^8) reach the driver, where EM estimates, without any given label, how often each labeller votes each way on good
and on bad documents, and how many kinds of bad documents there are. A document's posterior follows from its pattern. A linear scorer over hashed words
and word shapes is then trained on posteriors of a bounded sample and scores every document.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import Memo, cut, run_folder, steps, table

GOOD, BAD, ABSTAIN = "1", "0", "-"
# The scorer is trained on at most this many documents, those with the smallest hash of doc_id and text.
TRAIN_DOCS = 8_000
BUCKETS = 1 << 16
EPOCHS = 3
# Words of a stretch of text whose distinct words are counted.
STRETCH = 1000
# The prior of the label model counts as this many votes of each labeller in each class, however many were cast.
BELIEF = 2.0
# A labeller that calls more of the good documents bad does not start a kind of bad.
SELDOM = 0.1

NO_LETTERS = bytes(i for i in range(128) if not chr(i).isalpha())
BEYOND_ASCII = re.compile(r"[^\x00-\x7f]+")


def band(value: float, good: float, bad: float) -> str:
    """Good up to ``good``, bad from ``bad``, abstaining between."""
    return GOOD if value <= good else BAD if value >= bad else ABSTAIN


def count_letters(text: str) -> int:
    """Characters of the whole text that are letters, as ``str.isalpha`` says; ASCII ones are counted as bytes."""
    ascii_ones = len(text.encode("ascii", "ignore").translate(None, NO_LETTERS))
    return ascii_ones if text.isascii() else ascii_ones + sum(map(str.isalpha, "".join(BEYOND_ASCII.findall(text))))


def votes(text: str | None) -> str:
    """One character per labeller. A text without words is bad in the eyes of the first and nobody else's concern."""
    words = text.split() if text else []
    n = len(words)
    if not n:
        return BAD + ABSTAIN * 7
    chars = sum(map(len, words))
    letters = count_letters(text)
    upper = sum(w.isupper() and len(w) > 1 for w in words) / n
    tails = sum(not w[-1].isalnum() for w in words) / n
    marked = sum(len(w) > 1 and not w[-2:].isalnum() and not w[-2].isalnum() for w in words) / n
    alone = sum(not any(map(str.isalnum, w)) for w in words) / n
    same = sum(map(str.__eq__, words, words[1:])) / n
    # distinct words of each stretch of at most STRETCH words, over all stretches, so that length does not lower the share
    m = -(-n // STRETCH)
    kinds = sum(len(set(words[k * n // m:(k + 1) * n // m])) for k in range(m)) / n
    mean = chars / n
    return "".join((
        GOOD if n >= 50 else BAD if n < 2 else ABSTAIN,
        band(upper, 0.1, 0.3),
        band(tails, 0.25, 0.6) if n >= 40 else ABSTAIN,  # a short text has many sentence ends
        band(marked, 0.03, 0.15),
        band(alone, 0.02, 0.1),
        band(same, 0.03, 0.15),
        GOOD if kinds >= 0.3 else BAD if kinds < 0.15 else ABSTAIN,
        GOOD if 3 <= mean <= 9 and letters / chars >= 0.85 else BAD if letters / chars < 0.7 else ABSTAIN,
    ))


def fit(n: np.ndarray, hot: np.ndarray, start: np.ndarray, share: np.ndarray, belief: float, rounds: int):
    """EM from ``start`` (class x labeller x vote), which counts as ``belief`` votes: log-likelihood, votes, posteriors."""
    flat, right, before = hot.reshape(len(hot), -1), start, -math.inf
    for _ in range(rounds):
        like = np.log(share)[None] + flat @ np.log(right).reshape(len(right), -1).T
        top = like.max(1, keepdims=True)
        post = np.exp(like - top)
        total = post.sum(1, keepdims=True)
        post /= total
        fits = float(n @ (top + np.log(total))[:, 0])
        mass = n[:, None] * post
        share = (mass.sum(0) + 1) / (n.sum() + len(share))
        right = (mass.T @ flat).reshape(start.shape) + belief * start
        right /= right.sum(2, keepdims=True)
        if abs(fits - before) <= 1e-9 * abs(fits):
            break
        before = fits
    return fits, right, post


def em(counts: dict[str, int], belief: float = BELIEF, rounds: int = 2000) -> dict[str, float]:
    """Pattern -> posterior of good. Votes are independent given the class: good, or one of the kinds of bad.

    Abstaining says nothing about the class, so only votes enter the likelihood. Shares of the classes and how each labeller votes
    in each are estimated; the start, that a labeller seldom calls a good document bad and misses many bad ones,
    stays as a prior of ``belief`` votes for each labeller and class, whatever the size of the corpus.

    There is one kind of bad at first. One more, which starts as what a single labeller finds that seldom calls good documents
    bad, is added while that lowers the Bayesian information criterion and some labeller calls most documents of each added kind bad.
    """
    patterns = sorted(counts)
    if not patterns:
        return {}
    n = np.array([counts[p] for p in patterns], float)
    # one-hot votes: pattern x labeller x (bad, good)
    hot = np.array([[[v == BAD, v == GOOD] for v in p] for p in patterns], float)
    labellers = hot.shape[1]
    bad, good = np.tile([0.25, 0.75], (labellers, 1)), np.tile([0.003, 0.997], (labellers, 1))

    def model(found: list[int]):
        kinds = [np.where(np.arange(labellers)[:, None] == k, [0.75, 0.25], good) for k in found]
        bads = 1 + len(kinds)
        fits, right, post = fit(n, hot, np.stack([bad, *kinds, good]), np.array([0.2 / bads] * bads + [0.8]), belief, rounds)
        return -2 * fits + bads * (labellers + 1) * math.log(n.sum()), found, right, post

    best = model([])
    while True:
        tries = [model([*best[1], k]) for k in range(labellers) if k not in best[1] and best[2][-1, k, 0] <= SELDOM]
        better = [t for t in tries if t[0] < best[0] and (t[2][1:-1, :, 0].max(1) >= 0.5).all()]
        if not better:
            return dict(zip(patterns, best[3][:, -1].tolist(), strict=True))
        best = min(better, key=lambda t: t[0])


ASCII_SIGNS = {i: "A" if chr(i).isupper() else "a" if chr(i).isalpha() else "0" if chr(i).isdigit() else chr(i) for i in range(128)}
RUN = re.compile(r"([aA0])\1+")


def shape(word: str) -> str:
    """Letters, capitals and digits each as one sign for a run; other characters as they are."""
    signs = word.translate(ASCII_SIGNS) if word.isascii() else "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return RUN.sub(r"\1", signs)


def buckets(word: str) -> tuple[int, int]:
    return xxhash.xxh32_intdigest(word.lower()) % BUCKETS, BUCKETS + xxhash.xxh32_intdigest(shape(word)) % BUCKETS


def train(epochs: int = EPOCHS, rate: float = 2.0):
    """mapInArrow over (text, posterior) in one partition of bounded size: one row, weights and bias."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, rows = Memo(buckets), []
        for part in steps(batches):
            for text, y in zip(part.column("text").to_pylist(), part.column("posterior").to_pylist(), strict=True):
                words = (text or "").split()
                if words:
                    idx, c = np.unique(np.array([b for w in words for b in memo[w]], np.int32), return_counts=True)
                    rows.append((idx, c / len(words), y))
        if not rows:
            return
        w, bias, seen = np.zeros(2 * BUCKETS), 0.0, np.full(2 * BUCKETS, 1e-3)
        for e in range(epochs):
            for k in np.random.default_rng(e).permutation(len(rows)):
                idx, x, y = rows[k]
                err = y - 1 / (1 + math.exp(-min(30.0, max(-30.0, float(w[idx] @ x) + bias))))
                seen[idx] += (err * x) ** 2
                w[idx] += rate * err * x / np.sqrt(seen[idx])
                bias += 0.01 * err
        yield pa.record_batch([pa.array([w.astype(np.float32).tobytes()]), pa.array([bias])], ["weights", "bias"])
    return run


def vote_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in steps(batches):
        yield pa.record_batch([part.column("doc_id"), part.column("text"), pa.array([votes(t) for t in part.column("text").to_pylist()])], ["doc_id", "text", "pattern"])


def pattern_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in steps(batches):
        yield pa.record_batch([pa.array([votes(t) for t in part.column("text").to_pylist()])], ["pattern"])


def rate_rows(posterior: dict[str, float], weights: bytes | None, bias: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.frombuffer(weights, np.float32) if weights else np.zeros(2 * BUCKETS, np.float32)
        memo = Memo(lambda word: float(sum(w[b] for b in buckets(word))))
        for part in steps(batches):
            patterns, scores = [], []
            for t in part.column("text").to_pylist():
                words = (t or "").split()
                patterns.append(votes(t))
                z = sum(map(memo.__getitem__, words)) / len(words) + bias if words else -30.0
                scores.append(1 / (1 + math.exp(-min(30.0, max(-30.0, z)))))
            yield pa.record_batch([part.column("doc_id"), pa.array(patterns), pa.array([posterior[p] for p in patterns]), pa.array(scores)],
                                  ["doc_id", "pattern", "posterior", "score"])
    return run


def rate(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, pattern, posterior, score) of every row; ``score`` is the scorer's probability of good.

    A text that is null or has no words scores 0. Null doc_ids and repeated rows each give a row; other
    columns are not read. No rows give no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    counts = docs.select("text").mapInArrow(pattern_counts, "pattern string").groupBy("pattern").count()
    posterior = em({r["pattern"]: r["count"] for r in counts.collect()})  # at most 3^8 patterns
    order = F.xxhash64("doc_id", "text")
    least = docs.select("doc_id", order.alias("h")).orderBy("h", "doc_id").limit(train_docs)
    sample = cut(docs.withColumn("h", order).join(F.broadcast(cut(least, folder := run_folder(spark, "quality"), "ids").select("h").distinct()), "h", "left_semi")
                 .dropDuplicates(["h"]).select("doc_id", "text").mapInArrow(vote_rows, "doc_id bigint, text string, pattern string"), folder, "sample")
    pairs = [(p, v) for p, v in posterior.items()]
    known = spark.createDataFrame(pairs, "pattern string, posterior double") if pairs else spark.createDataFrame([], "pattern string, posterior double")
    model = (sample.join(F.broadcast(known), "pattern").select("text", "posterior").coalesce(1)
             .mapInArrow(train(), "weights binary, bias double").collect())
    weights, bias = (bytes(model[0]["weights"]), model[0]["bias"]) if model else (None, 0.0)
    return docs.mapInArrow(rate_rows(posterior, weights, bias), "doc_id bigint, pattern string, posterior double, score double")


def op2_quality_classifier(spark, sf_dir: str) -> DataFrame:
    rated = rate(table(spark, sf_dir, "documents"))
    return rated.select("doc_id", F.length(F.regexp_replace("pattern", ABSTAIN, "")).cast("bigint").alias("n_votes"), "posterior", "score",
                        (F.col("score") >= 0.5).alias("kept"), (F.col("score") >= 0.5).cast("int").alias("predicted"))
