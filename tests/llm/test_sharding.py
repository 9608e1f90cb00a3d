"""Sharding against a plain sort and the network in Python, on odd, repeated, empty and hot tables."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm_fixtures import empty, odd  # noqa: F401
from tillstar.llm import sharding
from tillstar.llm.common import run_folder


def network(x, n, seed=sharding.SEED):
    a, b = sharding.grid(n)
    left, right = x % a, x // a
    draw = lambda k, half, side: int(hashlib.md5(f"{seed}:{k}:{half}".encode()).hexdigest()[:15], 16) % side
    for k in range(sharding.ROUNDS):
        if k % 2 == 0:
            left = (left + draw(k, right, a)) % a
        else:
            right = (right + draw(k, left, b)) % b
    return left + right * a


def walked(x, n):
    p = network(x, n)
    while p >= n:
        p = network(p, n)
    return p


def brute(rows, shards=sharding.SHARDS):
    """(doc_id, size, crc, shard, slot) of (doc_id, text) rows."""
    rows = sorted(rows, key=lambda r: hashlib.md5(f"{'' if r[0] is None else r[0]}:{r[1] or ''}".encode()).hexdigest())
    out = []
    for i, (doc_id, text) in enumerate(rows):
        p, raw = walked(i, len(rows)), (text or "").encode()
        out.append((doc_id, len(raw) + 1, zlib.crc32(raw), p % shards, p // shards))
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 10, 16, 17, 50, 97, 1000, 4097])
def test_permutation_is_whole_and_has_an_inverse(spark, n):
    rows = spark.range(n).select("id", sharding.permute(F.col("id"), n).alias("p"), sharding.place(F.col("id"), n, 3).alias("at"))
    rows = rows.withColumn("back", sharding.row_at(F.col("at.shard"), F.col("at.slot"), n, 3)).collect()
    assert sorted(r["p"] for r in rows) == list(range(n))
    assert all(r["back"] == r["id"] and r["p"] == walked(r["id"], n) for r in rows)
    assert all((r["at"]["shard"], r["at"]["slot"]) == (r["p"] % 3, r["p"] // 3) for r in rows)


def test_places_equal_brute_force(spark, odd):
    got = Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in sharding.deal(odd).collect())
    assert got == Counter(brute([(r["doc_id"], r["text"]) for r in odd.collect()]))


def test_rows_per_shard_and_slots(spark, odd):
    rows = sharding.deal(odd, shards=7).collect()
    slots = {k: sorted(r["slot"] for r in rows if r["shard"] == k) for k in range(7)}
    assert all(s == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_layout_of_the_table_does_not_matter(spark, odd):
    one, other = (Counter(map(tuple, sharding.deal(d).collect())) for d in (odd.coalesce(1), odd.orderBy(F.desc("n_chars")).repartition(7)))
    assert one == other
    assert one != Counter(map(tuple, sharding.deal(odd, seed="another").collect()))


def test_hot_copies_are_dealt_in_chunks_and_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK", 3)
    monkeypatch.setattr(sharding, "BUCKET", 2)
    monkeypatch.setattr(sharding, "TOGETHER_BITS", 2)
    rows = [(i, f"text {i}") for i in range(60)] + [(7, "copy")] * 31 + [(None, None)] * 4 + [(None, "")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in sharding.deal(docs).collect())
    assert got == Counter(brute(rows))


def test_empty_table(spark, empty):
    assert sharding.deal(empty).collect() == []


def test_written_shards_hold_whole_rows_in_slot_order(spark, odd):
    path = run_folder(spark, "test-shards")
    sharding.write_shards(odd, path, shards=3)
    back = spark.read.parquet(path)
    assert Counter(map(tuple, back.select(*odd.columns).collect())) == Counter(map(tuple, odd.collect()))
    sizes = Counter(r["shard"] for r in back.collect())
    assert len(sizes) == 3 and max(sizes.values()) - min(sizes.values()) <= 1
    assert back.select("shard", "slot").distinct().count() == odd.count()
    with pytest.raises(ValueError, match="slot"):
        sharding.write_shards(odd.withColumn("Slot", F.lit(1)), path + "-x")


def test_plan_has_no_python(spark, odd):
    plan = sharding.deal(odd)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
