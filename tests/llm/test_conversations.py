"""Conversation repair against a plain DP over strings, with pieces that cut conversations."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from tillstar.llm import conversations as repair
from tillstar.llm.common import run_folder

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def harmed(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        out += [(conv, turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, repaired rows) by forward reasoning on suffixes: the best way from (row, state) to the end."""
    n = len(rows)
    grammar = {("B", "s"): "S", ("B", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}

    @lru_cache(None)
    def best(i, state, inserts=0):
        ways = [(0, "", ())] if i == n and state in "BA" else []
        if i < n:
            role, text, fault = rows[i]
            cost, audit, out = best(i + 1, state)
            ways.append((3 + cost, "D" + audit, out))
            if fault in ("fine", "truncated"):
                more = int(fault == "truncated")
                for letter, price, said in (("K", 0, role), ("R", 2, "user"), ("R", 2, "assistant")):
                    if (state, said[:1]) in grammar:
                        cost, audit, out = best(i + 1, grammar[state, said[:1]])
                        ways.append((price + more + cost, letter + audit, ((said, text), *out)))
        if inserts < 3:
            for said in ("user", "assistant"):
                if (state, said[0]) in grammar:
                    cost, audit, out = best(i, grammar[state, said[0]], inserts + 1)
                    ways.append((2 + cost, "I" + audit, ((said, ""), *out)))
        return min(ways, default=(10**9, "", ()))

    import sys
    sys.setrecursionlimit(100_000)
    return best(0, "B")


def brute(original, damaged):
    out = []
    for conv in {r[0] for r in original}:
        rows = [(t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in damaged if c == conv]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        turns = [t for t, _, _ in rows if t is not None]
        faults, seen = [], set()
        for _, role, text in rows:
            shown = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "fine" if shown[-1] in ".!?" else "truncated")
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, repaired = cheapest([(role, text, fault) for (_, role, text), fault in zip(rows, faults)])
        text = "\n".join(f"{role}:{said}" for role, said in repaired)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(k) for k in ("blank", "duplicate", "truncated")],
                    illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 5) for r in rows], "conv_id long, turn long, role string, text string, audit string, Piece int")


def told(original, damaged):
    got = repair.report(original, damaged, run_folder(original.sparkSession, "test-conversations"))
    assert got.columns[:1] == ["conv_id"] and set(got.columns) == set(COLUMNS)
    return sorted(map(tuple, got.select(COLUMNS).collect()), key=lambda r: (r[0] is not None, r[0] or 0))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    texts = ["Good day.", "Why?", "no stop", "", "  \n", "Fine!", "half a", "Ünd so.", "日本", "end. \t"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    made = []
    for conv in range(150):
        n = rng.choice((1, 2, 3, 5, 8, 12))
        usual = [(["system"] if rng.random() < .4 else []) + ["user", "assistant"] * n][0][:n]
        for turn in range(n):
            role = usual[turn] if rng.random() < .75 else rng.choice(roles)
            text = f"{rng.choice(texts)} {rng.randrange(9)}{rng.choice(('.', '', '?'))}" if rng.random() < .7 else rng.choice([*texts, None])
            made.append((conv, turn * rng.choice((1, 1, 1, 2)) if rng.random() < .95 else None, role, text))
    made += [(None, t, r, "From nobody.") for t, r in ((None, "user"), (1, "assistant"), (1, "user"))]
    return made + made[20:24] + [(900, None, None, None), (901, 5, "user", "u" * 300_000)]


def test_damage_equals_brute_force(spark, rows):
    got = sorted(map(tuple, repair.damage(frame(spark, rows)).collect()), key=str)
    assert got == sorted(harmed(rows), key=str)


def test_report_equals_brute_force(spark, rows):
    assert told(frame(spark, rows), repair.damage(frame(spark, rows))) == brute(rows, harmed(rows))


def test_long_conversations_cross_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(repair, "PART_BYTES", 50)
    rng = random.Random(2)
    rows = [(7, t, rng.choice(("user", "assistant", "assistant", "system")), rng.choice(("A.", "b", "", f"No {t}."))) for t in range(400)]
    rows += [(c, t, "ua"[t % 2] + "x", f"Say {t}.") for c in (3, 8) for t in range(5)] + [(9, 1, "user", "The same.")] * 150
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert told(frame(spark, rows).repartition(5), frame(spark, rows)) == brute(rows, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_repaired_rows_follow_the_grammar(spark, rows):
    folder = run_folder(spark, "test-conversations")
    ordered, edits = repair.repair(repair.damage(frame(spark, rows)), folder)
    said = {}
    for r in repair.repaired_rows(ordered, edits).orderBy("piece", "pos", "part").collect():
        said.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert all(re.fullmatch("(s?(ua)+)?", "".join(role[:1] for role, _ in turns)) for turns in said.values())
    digests = {r["conv_id"]: r["repaired_sha256"] for r in repair.digests(ordered, edits).collect()}
    for conv, turns in said.items():
        assert digests[conv] == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in turns).encode()).hexdigest()


def test_empty_table_and_no_rows_left(spark):
    none = frame(spark, [])
    assert told(none, repair.damage(none)) == []
    rows = [(1, 1, "user", "a."), (None, 2, "user", "b.")]
    empty = hashlib.sha256().hexdigest()
    assert told(frame(spark, rows), frame(spark, []).where(F.lit(False))) == [(None, 0, 0, 0, 0, 0, 0, "", empty), (1, 0, 0, 0, 0, 0, 0, "", empty)]


def test_text_conv_ids(spark):
    rows = [("a", 1, "user", "Hi."), ("a", 2, "user", "Ho."), ("b", 1, "system", "Be.")]
    docs = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    got = {r["conv_id"]: (r["cost"], r["audit"]) for r in repair.report(docs, docs, run_folder(spark, "test-conversations")).collect()}
    assert got == {"a": (2, "KR"), "b": (3, "D")}
