"""Toxicity: a weighted lexicon found by Aho-Corasick in folded text, normalised by length.

Folding lower-cases, maps homoglyphs and digit substitutions to Latin letters and turns punctuation into
single spaces; the lexicon is learned from folded text too. Its entries are whole words and word beginnings
that are far likelier in toxic than in clean training documents. An entry's weight is a log-odds over the toxic
documents that earlier entries left unexplained, so words that merely come along with copies of one document
weigh little. Phrases in which a lexicon word is harmless (given ones, and those seen in clean training documents only) mask the matches inside.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import cut, held_out, run_folder, steps, table

FOLDS = 5
# The lexicon is fitted on at most this many labelled rows, those with the smallest hash of doc_id.
TRAIN_DOCS = 20_000
# A lexicon entry or exception stands in at least this many training documents.
SUPPORT = 3
# Least log-odds of a lexicon entry; most entries.
LEAST_ODDS = 3.0
MOST_ENTRIES = 2_000
PREFIXES = (4, 5, 6)
# Harmless phrases, digit substitutions, and letters that look like Latin ones.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "sore loser rule", "pathetic fallacy")
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ո": "n", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ı": "i", "ɡ": "g", "ɑ": "a",
}


def folding() -> dict[int, str]:
    """Translation table for lower-cased text. Zero-width characters go; fullwidth letters become plain ones."""
    t = {ord(k): v for k, v in LOOKALIKES.items()}
    t |= {0xFF41 + i: chr(97 + i) for i in range(26)} | {0xFF10 + i: DIGITS.get(str(i), str(i)) for i in range(10)}
    t |= {c: None for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}
    t |= {c: " " for c in range(128) if not chr(c).isalnum()}
    return t | {ord(k): v for k, v in DIGITS.items()}


FOLDING = folding()


def fold(text: str | None) -> list[str]:
    return text.lower().translate(FOLDING).split() if text else []


def entries_of(words: list[str]) -> set[str]:
    """Lexicon candidates: `` word `` for a whole word, `` begin`` for a word's beginning."""
    out = set()
    for w in set(words):
        out.add(f" {w} ")
        out.update(f" {w[:n]}" for n in PREFIXES if len(w) > n)
    return out


def counted(make) -> object:
    """mapInArrow over (text, toxic): (entry, n) where ``make(words)`` names a document's entries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            c = Counter()
            for t in part.column("text").to_pylist():
                c.update(make(fold(t)))
            yield pa.record_batch([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], ["entry", "n"])
    return run


def tally(rows: DataFrame, make, least: int) -> dict[str, int]:
    found = rows.select("text").mapInArrow(counted(make), "entry string, n bigint").groupBy("entry").agg(F.sum("n").alias("n"))
    return {r["entry"]: r["n"] for r in found.where(F.col("n") >= least).toLocalIterator()}


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    # logistic coefficients over (1, log1p(sum), log1p(sum per 200 words))
    beta: tuple[float, float, float] = (-4.0, 0.0, 0.0)


class Matcher:
    def __init__(self, lexicon: Lexicon):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for e, w in lexicon.weights.items():
            self.automaton.add_word(e, (len(e), w, e))
        for e in lexicon.exceptions:
            phrase = f" {' '.join(fold(e))} "
            self.automaton.add_word(phrase, (len(phrase), None, phrase))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def matches(self, words: list[str]) -> list[tuple[int, str, float]]:
        """(start, entry, weight) in the folded text, without those inside an exception phrase."""
        if self.empty or not words:
            return []
        hits = list(self.automaton.iter(f" {' '.join(words)} "))
        masks = [(end - n + 1, end) for end, (n, w, _) in hits if w is None]
        return [(end - n + 1, e, w) for end, (n, w, e) in hits
                if w is not None and not any(a <= end - n + 1 and end <= b for a, b in masks)]

    def strength(self, words: list[str]) -> float:
        """Sum over matched word positions of the heaviest entry there."""
        best: dict[int, float] = {}
        for start, _, w in self.matches(words):
            best[start] = max(w, best.get(start, 0.0))
        return sum(best.values())


def features(strength: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    return np.stack([np.ones_like(strength), np.log1p(strength), np.log1p(200 * strength / (n_words + 20))], 1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 50) -> tuple[float, ...]:
    """Ridge logistic regression by damped Newton steps; the two classes weigh alike."""
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    beta = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (y - p)) - penalty @ beta
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(hess, grad)
        beta += step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def choose(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int, where: dict[str, list[int]]) -> dict[str, float]:
    """Entries by how many documents' need they meet; a document needs three matches.

    ``where``: entry -> documents. The weight is the log-odds over the documents still in need.
    """
    need = Counter({d: 3 for docs in where.values() for d in docs})
    weights: dict[str, float] = {}
    gain = {e: float(len(docs)) for e, docs in where.items()}
    while gain and len(weights) < MOST_ENTRIES:
        e = max(gain, key=lambda x: (gain[x], x))
        now = sum(min(1, need[d]) * need[d] / 3 for d in where[e])
        if now < gain[e] - 1e-9:  # documents were met meanwhile; look again
            gain[e] = now
            if now < SUPPORT - 1e-9:
                del gain[e]
            continue
        if now < SUPPORT - 1e-9:
            break
        weights[e] = math.log((now + 0.5) / (n_toxic + 1)) - math.log((clean.get(e, 0) + 0.5) / (n_clean + 1))
        if weights[e] < LEAST_ODDS:
            del weights[e]
        else:
            for d in where[e]:
                need[d] = max(0, need[d] - 1)
        del gain[e]
    return weights


def contexts(matcher: Matcher):
    """Two-word phrases around matches."""
    def make(words: list[str]) -> set[str]:
        out = set()
        at, pos = {}, 0
        for k, w in enumerate(words):
            at[pos] = k
            pos += len(w) + 1
        for start, _, _ in matcher.matches(words):
            k = at.get(start)
            if k is not None:
                out.update(" ".join(words[a:a + 2]) for a in (k - 1, k) if 0 <= a < len(words) - 1)
        return out
    return make


def learn(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """Fit on training rows (crc32(doc_id) mod 5 is not 0) of a bounded sample of the labels.

    Rows without a label or doc_id teach nothing. Without toxic or without clean rows the lexicon is empty.
    """
    spark = docs.sparkSession
    train = (labels.where(~held_out(F.col("doc_id"), FOLDS) & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
             .select("doc_id", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(train_docs))
    folder = run_folder(spark, "toxicity")
    train = cut(train, folder, "train")  # at most train_docs rows of two numbers: small enough to broadcast
    rows = cut(docs.select("doc_id", "text").join(F.broadcast(train), "doc_id").select("text", "toxic"), folder, "texts")
    toxic, clean = rows.where("toxic = 1").dropDuplicates(["text"]), rows.where("toxic = 0")
    n_toxic, n_clean = toxic.count(), clean.count()
    if not n_toxic or not n_clean:
        return Lexicon(exceptions=exceptions)
    found = tally(toxic, entries_of, SUPPORT)
    common = tally(clean, lambda words: entries_of(words) & found.keys(), 1)
    odds = lambda e: math.log((found[e] + 0.5) / (n_toxic + 1)) - math.log((common.get(e, 0) + 0.5) / (n_clean + 1))
    found = {e: n for e, n in found.items() if odds(e) >= LEAST_ODDS}

    def incidence(batches):
        for part in steps(batches):
            docs_of = [(h, e) for h, t in zip(part.column("h").to_pylist(), part.column("text").to_pylist(), strict=True) for e in entries_of(fold(t)) & found.keys()]
            yield pa.record_batch([pa.array([x[0] for x in docs_of], pa.int64()), pa.array([x[1] for x in docs_of], pa.string())], ["h", "entry"])

    where: dict[str, list[int]] = {}
    for r in toxic.select(F.xxhash64("text").alias("h"), "text").mapInArrow(incidence, "h bigint, entry string").toLocalIterator():
        where.setdefault(r["entry"], []).append(r["h"])
    lexicon = Lexicon(choose(found, common, n_toxic, n_clean, where), exceptions)
    in_clean = tally(clean, contexts(Matcher(lexicon)), SUPPORT)
    in_toxic = tally(toxic, contexts(Matcher(lexicon)), 1) if in_clean else {}
    lexicon.exceptions += tuple(sorted(p for p, n in in_clean.items() if n / n_clean > 20 * in_toxic.get(p, 0) / n_toxic))
    fit = np.array([tuple(r) for r in rows.mapInArrow(measure(lexicon, "toxic"), "key bigint, strength double, n_words bigint").toLocalIterator()])
    lexicon.beta = logistic(features(fit[:, 1], fit[:, 2]), fit[:, 0])
    return lexicon


def measure(lexicon: Lexicon, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for part in steps(batches):
            folded = [fold(t) for t in part.column("text").to_pylist()]
            yield pa.record_batch([part.column(key).cast(pa.int64()), pa.array([matcher.strength(w) for w in folded], pa.float64()),
                                   pa.array([len(w) for w in folded], pa.int64())], ["key", "strength", "n_words"])
    return run


def score_column(lexicon: Lexicon, strength, n_words):
    b = lexicon.beta
    z = b[0] + b[1] * F.log1p(strength) + b[2] * F.log1p(200 * strength / (n_words + 20))
    return 1 / (1 + F.exp(-z))


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """All columns of ``docs`` that this module names (doc_id, text aside): (doc_id, score).

    A null text is the empty one and gets the score of a text without matches; null doc_ids and
    repeated rows each give a row; other columns are not read. No rows give no rows.
    """
    measured = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        measure(lexicon, "doc_id"), "key bigint, strength double, n_words bigint")
    return measured.select(F.col("key").alias("doc_id"), score_column(lexicon, F.col("strength"), F.col("n_words")).alias("score"))


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = learn(docs, table(spark, sf_dir, "labels"))
    return score(docs, lexicon).select("doc_id", held_out(F.col("doc_id"), FOLDS).alias("held_out"), "score",
                                       (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Pipeline stage: rows whose text scores below 0.5, all columns as they are (null texts stay)."""
    from pyspark.sql import types as T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for part in steps(batches):
            folded = [fold(t) for t in part.column("text").to_pylist()]
            x = features(np.array([matcher.strength(w) for w in folded]), np.array([float(len(w)) for w in folded]))
            yield part.filter(pa.array(x @ np.array(lexicon.beta) < 0))
    return docs.mapInArrow(run, T.StructType(docs.schema.fields))
