"""Source divergence audit: how far the word use of the sources of a language lies apart.

Terms are runs of ASCII letters and non-ASCII characters, ``A-Z`` lower-cased. A language keeps the terms that at
least ``least_docs`` of its documents hold. Each (lang, source) group and each language gives a kept term the
chance p = 1 + floor(10^9 * (count + 2) / (N + 2 * V)), N the counts' sum, V the kept terms of the language, and
two chances differ by f = floor((p - q)^2 / (p + q)); integers throughout. The audit sums f over all kept
terms for each pair of sources of a language, and lists the terms each group uses more than its language.

Pairs are priced by sparse merges. The kept terms of a language are hashed into blocks and numbered in each,
so a group's counts are short sorted arrays (term id, count), one per block. Sources form tiles of 16; a task gets the
arrays of two tiles for one block and merges each unordered pair once: a galloping intersection prices
overlaps, the rest of each array meets the other's chance of an absent term, and the terms of the block that neither
holds are priced at once. f is the same both ways. So a task holds at most 32 arrays of one block, and an array is sent
once per tile, not once per partner.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstar.llm.common import cut, run_folder, steps, table

LEAST_DOCS = 10
TOP = 10
UNIT = 1_000_000_000
# Kept terms of a language in one block on average, sources in one tile.
BLOCK_TERMS = 16_384
TILE = 16
# Entries that a task counts before it hands them on, and bytes of one text that are split at once.
ENTRIES = 1 << 18
SLICE = 4 << 20
# Letters in lower case and the bytes of non-ASCII characters stay, all else separates.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def term_slices(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a whole text in order, some megabytes of it at a time."""
    at = 0
    while at < len(text):
        part = text[at:at + SLICE].translate(LETTERS)
        at += len(part)
        while at < len(text) and not part.endswith(b" "):  # up to the end of the term
            more = text[at:at + 256].translate(LETTERS)
            cut_at = more.find(b" ")
            part += more if cut_at < 0 else more[:cut_at + 1]
            at += len(more) if cut_at < 0 else cut_at + 1
        yield part.split()


def count_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, df) summed over some documents; a null term marks that the group occurs."""
    found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, df) in found.items():
            terms = [None, *n]
            for at in range(0, len(terms), 1 << 16):
                part = terms[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()),
                    pa.array(part, pa.binary()).cast(pa.string()),
                    pa.array([n[t] if t is not None else 0 for t in part], pa.int64()), pa.array([df[t] if t is not None else 0 for t in part], pa.int64()),
                ], names=["lang", "source", "term", "n", "df"])

    for step in (s for b in batches for s in steps([b])):
        for lang, source, text in zip(step.column("lang").to_pylist(), step.column("source").to_pylist(), step.column("text").cast(pa.binary()).to_pylist(), strict=True):
            n, df = found.setdefault((lang, source), (Counter(), Counter()))
            held -= len(n)
            seen: set[bytes] = set()
            for terms in term_slices(text):
                n.update(terms)
                seen.update(terms)
            df.update(seen)
            held += len(n)
        if held > ENTRIES:
            yield from out()
            found.clear()
            held = 0
    yield from out()


def chance(count: Column, total: Column, kept: Column) -> Column:
    """p of the module docstring, in decimals wide enough for any long count."""
    above = (count + 2).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.lit(1) + F.call_function("div", above, (total + kept * 2).cast("decimal(21,0)"))


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def chances(count: np.ndarray, total: int, kept: int) -> np.ndarray:
    """``chance`` in numpy: long division by three decimal digits a step, so that nothing overflows below 9 * 10^15."""
    whole = total + 2 * kept
    rest, p = np.asarray(count, np.int64) + 2, np.int64(0)
    for _ in range(3):
        high, rest = np.divmod(rest * 1000, whole)
        p = p * 1000 + high
    return p + 1


def gallop(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """For each of the sorted ``keys`` the first place in the sorted ``among`` that is not below it.

    A key starts where an even spread would put it, gallops away in doubling steps until its place is
    bracketed, and the bracket is bisected; all keys at once.
    """
    n = len(among)
    if not n or not len(keys):
        return np.zeros(len(keys), np.int64)
    low = np.arange(len(keys)) * n // len(keys)
    high = low.copy()
    step = 1
    while (back := (low > 0) & (among[np.maximum(low, 1) - 1] >= keys)).any():
        high[back] = low[back] - 1
        low[back] = np.maximum(low[back] - step, 0)
        step *= 2
    step = 1
    while (on := (high < n) & (among[np.minimum(high, n - 1)] < keys)).any():
        low[on] = high[on] + 1
        high[on] = np.minimum(high[on] + step, n)
        step *= 2
    while (open_ := low < high).any():
        middle = (low + high) // 2
        below = open_ & (among[np.minimum(middle, n - 1)] < keys)
        low = np.where(below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)
    return low


def price(x: tuple, y: tuple, terms: int) -> int:
    """Sum of f over the ``terms`` of a block. x, y: sorted ids, their chances, the chance of an absent term."""
    def f(p, q):
        return (p - q) * (p - q) // (p + q)

    if len(x[0]) > len(y[0]):
        x, y = y, x
    (x_ids, x_p, x_0), (y_ids, y_p, y_0) = x, y
    at = gallop(x_ids, y_ids)
    both = at < len(y_ids)
    both[both] = y_ids[at[both]] == x_ids[both]
    at = at[both]
    y_only = np.ones(len(y_ids), bool)
    y_only[at] = False
    neither = terms - len(x_ids) - len(y_ids) + len(at)
    return int(f(x_p[both], y_p[at]).sum() + f(x_p[~both], y_0).sum() + f(y_p[y_only], x_0).sum()) + neither * int(f(x_0, y_0))


def price_tiles(group: pa.Table) -> pa.Table:
    """(lang, a, b, value) for the pairs of sources of two tiles (or within one) in one block of terms."""
    group = group.sort_by("number").combine_chunks()
    entries = group.column("entries").combine_chunks()
    ends, flat = np.asarray(entries.offsets), entries.values
    ids, counts = np.asarray(flat.field("id")).astype(np.int64), np.asarray(flat.field("n"))
    rows = group.drop_columns(["entries"]).to_pylist()
    arrays = []
    for r, a, b in zip(rows, ends[:-1], ends[1:], strict=True):
        arrays.append((ids[a:b], chances(counts[a:b], r["total"], r["kept"]), chances(np.zeros(1, np.int64), r["total"], r["kept"])[0]) if r["kept"] else None)
    out = {"lang": [], "a": [], "b": [], "value": []}
    for i, x in enumerate(rows):
        for j in range(i + 1, len(rows)):
            y = rows[j]
            if x["low"] != x["high"] and x["tile"] == y["tile"]:
                continue  # priced where the tile meets itself
            for name, value in (("lang", x["lang"]), ("a", x["source"]), ("b", y["source"]), ("value", price(arrays[i], arrays[j], x["terms"]) if arrays[i] else 0)):
                out[name].append(value)
    return pa.table(out, schema=pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())]))


def audit(docs: DataFrame, folder: str, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): parts ``pair`` (all ranks) and ``term`` (ranks to ``top``).

    Null lang, source and text read as ''. Every (lang, source) that occurs is a group, also without terms; a
    language that keeps no term gives pairs of value 0; one with a single source gives no pairs; an empty table
    no rows. Repeated rows count each. Only lang, source and text are read, so other columns cannot clash. Ties
    in value go to the item whose UTF-8 bytes come first.
    """
    said = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    partial = said.mapInArrow(count_terms, "lang string, source string, term string, n long, df long")
    counts = cut(partial.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df")), folder, "counts")
    by_lang = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("df").alias("df"))
    terms = cut(by_lang.where(F.col("df") >= least_docs).drop("df"), folder, "terms")
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n_lang").alias("total_lang"))
    blocks = -(-(langs.agg(F.max("kept")).first()[0] or 1) // BLOCK_TERMS)

    block = F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int")
    ids = terms.withColumn("block", block).withColumn("id", F.row_number().over(Window.partitionBy("lang", "block").orderBy("term")))
    ids = cut(ids, folder, "ids")
    kept = cut(counts.where("term is not null").join(ids, ["lang", "term"]).select("lang", "source", "term", "block", "id", "n", "n_lang"), folder, "kept")
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (counts.where("term is null").select("lang", "source").join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
              .na.fill(0, ["total", "kept", "total_lang"])
              .withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1))
    groups = cut(groups, folder, "groups")

    p, q = chance(F.col("n"), F.col("total"), F.col("kept")), chance(F.col("n_lang"), F.col("total_lang"), F.col("kept"))
    used = kept.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    term_part = used.withColumn("value", apart(F.col("p"), F.col("q"))).withColumn("rank", rank).where(F.col("rank") <= top)

    pairs = pair_values(groups, kept, ids, blocks)
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionAll(pairs.select("lang", F.col("b"), F.col("a"), "value"))
    pair_part = both.withColumn("rank", rank)
    return term_part.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank").unionAll(
        pair_part.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank"))


def pair_values(groups: DataFrame, kept: DataFrame, ids: DataFrame, blocks: int) -> DataFrame:
    """(lang, a, b, value): each unordered pair of sources of a language once."""
    tiles = groups.groupBy("lang").agg((F.call_function("div", F.max("number"), F.lit(TILE))).alias("last_tile"))
    entries = kept.groupBy("lang", "source", "block").agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("entries"))
    sizes = ids.groupBy("lang", "block").agg(F.count(F.lit(1)).alias("terms"))
    tile = F.call_function("div", F.col("number"), F.lit(TILE))
    dealt = (groups.join(tiles, "lang").withColumn("tile", tile).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
             .join(entries, ["lang", "source", "block"], "left").join(sizes, ["lang", "block"], "left").na.fill(0, ["terms"])
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last_tile"))))
             .select("lang", "source", "number", "tile", "block", "total", "kept", "terms", F.coalesce("entries", F.array().cast("array<struct<id:int,n:bigint>>")).alias("entries"), F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high")))
    priced = dealt.groupBy("lang", "block", "low", "high").applyInArrow(price_tiles, "lang string, a string, b string, value long")
    return priced.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), run_folder(spark, "divergence"))


def oracle_sql() -> str:
    """DuckDB: every group against every kept term, densely, in 128-bit integers."""
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
c AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT doc) AS df
  FROM (SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d) GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n_lang FROM c GROUP BY ALL HAVING sum(df) >= {LEAST_DOCS}),
v AS (SELECT lang, count(*) AS kept, sum(n_lang) AS total_lang FROM k GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.n_lang::HUGEINT AS n_lang, v.kept::HUGEINT AS kept, v.total_lang::HUGEINT AS total_lang,
    (sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source))::HUGEINT AS total
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (
  SELECT lang, source, term, n, 1 + ({UNIT} * (n + 2)) // (total + 2 * kept) AS p, 1 + ({UNIT} * (n_lang + 2)) // (total_lang + 2 * kept) AS q FROM dense),
summed AS (
  SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
  FROM p AS x JOIN p AS y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN summed AS s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= {TOP}"""
