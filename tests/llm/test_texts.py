"""Text operators against brute force, on tables with nulls, empty, long, tied and repeated rows."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from llm_fixtures import empty, odd  # noqa: F401
from tillstar.llm import jaccard, lm, mixing, packing, quality, secrets, token_counts, toxicity
from tillstar.llm.bpe import Encoder, tokenizer_path
from tillstar.llm.common import run_folder


def key(r):
    return tuple((x is None, x) for x in r)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


def words(text):
    return (text or "").encode().lower().split()


@pytest.fixture(scope="module")
def docs(odd):
    return [(r["doc_id"], r["text"], r["source"]) for r in odd.collect()]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


def test_encoder_gives_the_library_ids(library):
    import random
    rng, encoder = random.Random(1), Encoder(tokenizer_path())
    texts = ["", " ", "\n", "a\n\nb", " a  b ", "it's don't ’s", "<|endoftext|> a<|endoftext|>b", "１２ ab²c 日本語", "a\r\nb\x1cc", "x​z"]
    texts += ["".join(rng.choice("ab '.,\n\tsé1²日! <|") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    for t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        assert encoder.ids(t) == struct.pack(f"<{len(ids)}I", *ids), t


def test_token_counts_and_cache(spark, odd, docs, library, empty):
    cache = run_folder(spark, "test-cache")
    want = sorted(((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in docs), key=key)
    assert rows_of(token_counts.count_tokens(odd, cache)) == want
    stored = spark.read.parquet(cache).count()
    assert stored == len({t or "" for _, t, _ in docs})
    assert rows_of(token_counts.count_tokens(odd, cache)) == want          # from the cache
    assert spark.read.parquet(cache).count() == stored                     # nothing is encoded twice
    assert token_counts.count_tokens(empty, run_folder(spark, "test-cache")).count() == 0


def test_packing_round_trip(spark, odd, docs, library, empty):
    got = [r.asDict() for r in packing.pack(odd).collect()]
    ids = {}
    for i, t, _ in docs:
        ids.setdefault(i, []).append([*library.encode(t or "", add_special_tokens=False).ids, 0])
    want = Counter()
    for i, versions in ids.items():
        for v in versions:
            for k, (a, n) in enumerate(packing.cut_pieces(len(v), 2048)):
                want[i, k, a, n, zlib.crc32(struct.pack(f"<{n}I", *v[a:a + n]))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 2048
    assert len(bins) <= -(-sum(r["length"] for r in got) // 2048) + 1
    assert packing.pack(empty).count() == 0


def test_minimum_bin_slack_fills_bins():
    stock = {7: 3, 5: 4, 3: 6, 2: 1, 10: 2}
    patterns = packing.minimum_bin_slack(dict(stock), 10)
    used = Counter()
    for p in patterns:
        assert sum(n * k for n, k in p.lengths) <= 10
        for n, k in p.lengths:
            used[n] += k * p.bins
    assert used == stock
    assert sum(p.bins for p in patterns) == 9  # 81 of 90: no packing has fewer


def brute_classes(texts, n, num, den):
    def grams(t):
        w = words(t)
        return frozenset(tuple(w[a:a + n]) for a in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    sets = [(i, grams(t)) for i, t in texts]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and den * len(x & y) >= num * len(x | y):
                parent[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            low[find(k)] = min(i, low.get(find(k), i))
    return [(i, len(s), low.get(find(k), i) if s else i) for k, (i, s) in enumerate(sets)]


@pytest.mark.parametrize("measure", [jaccard.Measure(), jaccard.Measure(5, 80, 100)])
def test_jaccard_against_all_pairs(odd, docs, empty, measure):
    got = rows_of(jaccard.link(odd, measure).select("doc_id", "n_shingles", "component_id"))
    assert got == sorted(brute_classes([(i, t) for i, t, _ in docs], measure.n, measure.num, measure.den), key=key)
    assert jaccard.link(empty, measure).count() == 0


def test_keep_one_of_each_class(odd, docs):
    kept = jaccard.keep_one(odd, jaccard.Measure(5, 80, 100))
    assert kept.columns == odd.columns
    want = brute_classes([(i, t) for i, t, _ in docs], 5, 80, 100)
    alone = [i for i, n, _ in want if not n]
    assert rows_of(kept.select("doc_id")) == sorted(((c,) for c in [*{c for _, n, c in want if n}, *alone]), key=key)


def test_secrets(spark, odd, empty):
    texts = ["password = 'abcdefgh1' and TOKEN:short", "é AKIAABCDEFGHIJKL1 " + "0f" * 16, "api_key=12345678 secret: zzzzzzzzz", None, "", "ſecret=abcdefghij"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(9, texts[0]), (None, texts[1])], "doc_id long, text string")
    base = (("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8), ("access", r"AKIA[A-Z0-9]+", 0, 16), ("hex", r"[0-9a-f]+", 0, 32))

    def spans(t):
        found = [(m.start(), k, kind, m.end()) for k, (kind, p, g, n) in enumerate(base) for m in re.finditer(p, t or "") if len(m[g]) >= n]
        return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found))
    ledger = run_folder(spark, "test-ledger")
    got = {(r["doc_id"], r["s"]) for r in secrets.scan(docs, ledger).select("doc_id", secrets.spans_text(F.col("found")).alias("s")).collect()}
    assert got == {(r["doc_id"], spans(r["text"])) for r in docs.collect()}
    seen = spark.read.parquet(f"{ledger}/scanned").count()
    assert seen == 3 * len({t or "" for t in texts})
    newer = (*secrets.RULES[:2], secrets.Rule("hex", r"[0-9a-f]{16,}", 2))
    secrets.scan(docs, ledger, newer).count()
    assert spark.read.parquet(f"{ledger}/scanned").count() == seen * 4 // 3   # only the new rule version was run
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(docs, run_folder(spark, "test-ledger")).collect()}
    assert clean[0] == "[SECRET]' and TOKEN:short" and clean[3] is None and clean[5] == texts[5]
    assert secrets.scan(empty, run_folder(spark, "test-ledger")).count() == 0
    assert secrets.scan(odd, run_folder(spark, "test-ledger")).count() == odd.count()


def water_fill(sizes):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    capped, goal = set(), Fraction(3, 2) * sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        left = goal - sum(2 * sizes[s] for s in capped)
        level = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in capped else level * weight[s] for s in order}
        capped |= over


def test_mixing(odd, docs, empty):
    got = mixing.mix(odd, block_docs=20).select("doc_id", "source", "size", "source_size", "target", "copies").collect()
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += len(words(t))
    target = water_fill(dict(sizes))
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and 0 <= r["copies"] <= 2
        assert math.isclose(r["target"], float(target[r["source"]]), rel_tol=1e-9)
        taken[r["source"]] += r["size"] * r["copies"]
    biggest = max(r["size"] for r in got)
    assert all(abs(taken[s] - float(target[s])) <= biggest for s in sizes)
    assert sorted((r["doc_id"] is None, r["doc_id"], r["size"]) for r in got) == sorted((i is None, i, len(words(t))) for i, t, _ in docs)
    again = mixing.mix(odd.repartition(3), block_docs=20).select("doc_id", "source", "size", "source_size", "target", "copies")
    assert rows_of(again) == sorted((tuple(r) for r in got), key=key)       # reruns agree
    assert mixing.mix(empty).count() == 0
    repeated = mixing.repeat(odd)
    assert repeated.columns == odd.columns and repeated.count() == sum(r["copies"] for r in mixing.mix(odd, identity=tuple(odd.columns)).collect())


def test_flight_keeps_both_totals():
    import numpy as np
    rng = np.random.default_rng(3)
    size, prob = rng.integers(1, 1000, 500).astype(float), np.full(500, 0.37)
    out = mixing.flight(prob, size, np.random.default_rng(1))
    assert ((out > 1e-9) & (out < 1 - 1e-9)).sum() <= 2
    assert math.isclose(out.sum(), prob.sum(), rel_tol=1e-9) and math.isclose(out @ size, prob @ size, rel_tol=1e-9)


def test_language_model_baseline_is_exact(spark, odd, docs, empty):
    got = {}
    for r in lm.score(odd, head=64).collect():
        got.setdefault(r["doc_id"], []).append(r)
    counts = Counter()
    for i, t, _ in docs:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 10:
            counts.update([*words(t), "end"])
    n = sum(counts.values())
    for i, t, _ in docs:
        tokens = [*words(t), "end"]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (len(counts) + 1))) for w in tokens)
        assert any(math.isclose(r["base_score"], base, rel_tol=1e-9) and r["n_tokens"] == len(tokens) and r["n_known"] == sum(counts[w] > 0 for w in tokens)
                   and r["train_tokens"] == n and r["score"] < 0 for r in got[i])
    assert lm.score(empty).count() == 0


def test_language_model_is_a_probability():
    """Over all next words the model's chances sum to 1, and scores do not depend on the company in the batch."""
    import numpy as np
    from tillstar.llm import gru
    flat = gru.start(np.arange(100, 0, -1.0), 50.0, 2)
    trainer = gru.Trainer(flat)
    rng = np.random.default_rng(0)
    trainer.learn(rng.integers(0, 100, 5000).astype(np.int16), np.full(50, 100))
    start = rng.integers(0, 100, 70)
    tokens = np.concatenate([np.append(start, w) for w in range(gru.WORDS + 1)]).astype(np.int16)
    scores = gru.score(trainer.flat, tokens, np.full(gru.WORDS + 1, 71))
    alone = gru.score(trainer.flat, start.astype(np.int16), np.array([70]))[0]
    assert math.isclose(np.exp(scores - alone).sum(), 1, rel_tol=1e-3)


def test_toxicity_held_out(spark, empty):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.op6_toxicity(spark, sf).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.97 * len(rows)
    lexicon = toxicity.learn(docs, labels)
    matcher = toxicity.Matcher(lexicon)
    plain, disguised = matcher.strength(toxicity.fold("you moron")), matcher.strength(toxicity.fold("you m0rоn!"))
    assert plain == disguised > 0
    odd = [(1, None), (2, ""), (None, "a moron a clown a moron"), (3, "fine"), (3, "fine")]
    got = rows_of(toxicity.score(spark.createDataFrame(odd, "doc_id long, text string"), lexicon))
    assert len(got) == 5 and got[-1][0] is None and got[-1][1] > 0.5 and all(s < 0.5 for i, s in got if i is not None)
    assert toxicity.score(empty, toxicity.learn(empty, labels)).count() == 0


def test_exception_phrases_mask():
    m = toxicity.Matcher(toxicity.Lexicon({" trash ": 5.0}, ("trash can",)))
    assert m.strength(toxicity.fold("a trash can")) == 0 and m.strength(toxicity.fold("trash talk, trash can")) == 5


def test_quality_agrees_with_labels(spark, empty, odd):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality is not null")
    rows = quality.op2_quality_classifier(spark, sf).join(labels, "doc_id").collect()
    good = [r for r in rows if r["quality"] == 1]
    assert sum(r["kept"] for r in good) >= 0.98 * len(good)
    bad = [r for r in rows if r["quality"] == 0]
    assert sum(not r["kept"] for r in bad) >= 0.8 * len(bad)
    assert quality.rate(empty).count() == 0 and quality.rate(odd).count() == odd.count()


def test_em_finds_the_reliable_labellers():
    import random
    rng = random.Random(0)
    counts = Counter()
    for _ in range(4000):
        y = rng.random() < 0.7
        counts["".join("-" if rng.random() < 0.2 else str(int(y if rng.random() < a else not y)) for a in (0.95, 0.9, 0.6))] += 1
    post = quality.em(counts, belief=0.01)  # these labellers err both ways, so the prior hardly counts
    assert post["110"] > 0.9 and post["001"] < 0.1 and post["100"] > post["010"]


def test_em_estimates_with_the_default_prior():
    """op2: accuracies come from the votes, and the prior does not grow with them."""
    rng = random.Random(1)
    for n in (4_000, 100_000):
        counts = Counter()
        for _ in range(n):
            y = rng.random() < 0.7
            counts["".join("-" if rng.random() < 0.2 else str(int(y if rng.random() < a else not y)) for a in (0.95, 0.9, 0.6))] += 1
        post = quality.em(counts)
        assert post["110"] > 0.9 and post["001"] < 0.1 and post["100"] > post["010"]
    assert quality.em({}) == {}


def test_em_tells_kinds_of_bad_apart():
    """op2: a kind of bad that two labellers find is bad, though most others call it good."""
    counts = {"111111": 8600, "000111": 500, "001111": 100, "111100": 400, "111110": 60, "111101": 60}
    post = quality.em(counts)
    assert post["111111"] > 0.9 and post["000111"] < 0.1 and post["111100"] < 0.1


def test_letters_of_long_texts_are_counted_whole():
    """op2: the letter share is that of the whole text, however long."""
    for n in (10, 405, 10_000):
        for pair in ("alpha 12345 ", "12345 alpha "):
            assert quality.votes(pair * n)[-1] == quality.BAD  # half of the characters are letters
    for text in ("prices 98.50 " * 10_000, "größe ½ ٣ 漢字 x1 " * 900, "\ud800 a1"):
        assert quality.count_letters(text) == sum(map(str.isalpha, text))


def test_repetition_is_judged_at_every_length():
    """op2: a loop is bad however often it repeats, and a long text of ever new words is not."""
    for n in (30, 199, 200, 201, 2_000, 20_000):
        assert quality.votes("buy cheap pills online now " * n)[6] == quality.BAD
    for n in (100, 999, 1_001, 50_000):
        assert quality.votes(" ".join(f"w{k % 700}" for k in range(n)))[6] == quality.GOOD
    # half new words, half a loop: the stretches are averaged, not picked
    assert quality.votes(" ".join(f"w{k}" for k in range(500)) + " a b" * 4_000)[6] == quality.BAD


def test_base_hash_is_of_the_spans(spark):
    r = spark.createDataFrame([(1, "token=abcdefgh")], "doc_id long, text string")
    got = secrets.scan(r, run_folder(spark, "test-ledger")).select(secrets.spans_text(F.col("found"))).first()[0]
    assert got == "assign:0:14" and len(hashlib.sha256(got.encode()).hexdigest()) == 64


def test_stages_keep_columns_under_any_name(spark):
    """Columns named like those that the operators use inside, and map columns, pass through."""
    rows = [(i, t, "en", "s", len(t), 5, "d", "n", {"k": i}) for i, t in enumerate(["one two three four five six", "one two three four five six", "password=abcdefgh12 is here", "seven eight"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, __order int, __digest string, __node string, m map<string, int>")
    cleaned = secrets.redact(docs, run_folder(spark, "test-ledger"))
    assert cleaned.columns == docs.columns and {r["__digest"] for r in cleaned.collect()} == {"d"}
    assert [r["text"] for r in cleaned.collect() if r["doc_id"] == 2] == ["[SECRET] is here"]
    kept = jaccard.keep_one(docs, jaccard.Measure(5, 80, 100)).collect()
    assert sorted(r["doc_id"] for r in kept) == [0, 2, 3] and {r["__node"] for r in kept} == {"n"}
    mixed = mixing.repeat(docs).collect()
    assert {r["__order"] for r in mixed} == {5} and all(r["m"] == {"k": r["doc_id"]} for r in mixed)
