"""The source audit against a dense computation in Python integers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import empty, odd  # noqa: F401
from tillstar.llm import divergence
from tillstar.llm.common import run_folder

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, least=divergence.LEAST_DOCS, top=divergence.TOP):
    counts, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source, terms = lang or "", source or "", TERM.findall(lower(text))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        df[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        sources = sorted(s for l, s in groups if l == lang)
        kept = sorted(t for t, n in df[lang].items() if n >= least)

        def p(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])
        q, ps = p(whole), {s: p(counts[lang, s]) for s in sources}
        for s in sources:
            pair = [(o, sum(f(ps[s][t], ps[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, f(ps[s][t], q[t])) for t in kept if counts[lang, s][t] > 0 and ps[s][t] > q[t]]
            for part, items, most in (("pair", pair, None), ("term", term, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked[:most])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(lang, source, text, 1, "x") for lang, source, text in rows], "lang string, source string, text string, n int, term string")


def told(docs, **options):
    return sorted(map(tuple, divergence.audit(docs, run_folder(docs.sparkSession, "test-divergence"), **options).collect()))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma", "DELTA", "éclair", "ÉCLAIR", "straße", "日本", "x1y", "o'clock", "zeta"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9)]
    made = [(rng.choice(("en", "de")), f"s{min(rng.randrange(40), 21)}", " ".join(rng.choice(words[: rng.choice((9, 90))]) for _ in range(rng.choice((0, 1, 5, 60))))) for _ in range(500)]
    made += [(None, None, "solo " * 3), (None, "", None), ("", "a", ""), ("fr", "only", "seul " * 20), ("en", "wordless", "12 34 ..."), ("en", "wordless", None)]
    return made + [made[3]] * 7 + [("de", "s1", " ".join(rng.choice(words) for _ in range(40_000)))]


def test_equals_brute_force(spark, rows):
    assert told(frame(spark, rows)) == brute(rows)


def test_small_blocks_tiles_slices_and_flushes_change_nothing(spark, rows, monkeypatch):
    for name, value in (("BLOCK_TERMS", 5), ("TILE", 3), ("SLICE", 50), ("ENTRIES", 20)):
        monkeypatch.setattr(divergence, name, value)
    assert told(frame(spark, rows).repartition(5), least_docs=3, top=2) == brute(rows, 3, 2)


def test_odd_table_with_clashing_columns(spark, odd):
    got = told(odd.withColumn("df", F.lit(1)).withColumn("Number", F.lit(2)), least_docs=2)
    assert got == brute([(r["lang"], r["source"], r["text"]) for r in odd.collect()], 2)


def test_no_kept_terms_gives_pairs_of_value_zero(spark):
    rows = [("en", "b", "one"), ("en", "a", "two"), ("en", "c", None)]
    assert told(frame(spark, rows)) == [("en", "a", "pair", "b", 0, 1), ("en", "a", "pair", "c", 0, 2), ("en", "b", "pair", "a", 0, 1),
                                        ("en", "b", "pair", "c", 0, 2), ("en", "c", "pair", "a", 0, 1), ("en", "c", "pair", "b", 0, 2)]


def test_empty_table(spark, empty):
    assert told(empty) == []


def test_gallop_is_a_left_search():
    rng = np.random.default_rng(3)
    for _ in range(300):
        among = np.unique(rng.integers(0, 200, rng.integers(0, 60)))
        keys = np.unique(rng.integers(-5, 210, rng.integers(0, 60)))
        assert (divergence.gallop(keys, among) == np.searchsorted(among, keys)).all()
    ramp = np.arange(10_000)
    assert (divergence.gallop(ramp[-3:], ramp) == [9997, 9998, 9999]).all()


def test_chances_are_exact_for_counts_beyond_ten_digits():
    for count, total, kept in ((0, 0, 1), (3, 10, 4), (7 * 10**14, 8 * 10**14, 12345), (999_999_999_999, 10**12, 77)):
        assert int(divergence.chances(np.array([count]), total, kept)[0]) == 1 + 10**9 * (count + 2) // (total + 2 * kept)


def test_spark_chances_are_exact(spark):
    rows = [(0, 0, 1), (7 * 10**14, 8 * 10**14, 12345), (10**17, 2 * 10**17, 5)]
    got = spark.createDataFrame(rows, "c long, n long, v long").select(divergence.chance(F.col("c"), F.col("n"), F.col("v"))).collect()
    assert [r[0] for r in got] == [1 + 10**9 * (c + 2) // (n + 2 * v) for c, n, v in rows]
