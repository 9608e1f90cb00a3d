"""N-gram Jaccard join by parity sketches.

A text's set is its distinct word n-grams, each a 64-bit hash. Two sets link when
``den * |A & B| >= num * |A | B|``; so their symmetric difference is at most
``d = (den - num) / (den + num) * (|A| + |B|)``.

Sketch. Sets whose larger size lies in one size band share a sketch layout of K cells, more than the band's largest d. Every
n-gram belongs to one cell and XORs its hash into it: the cell holds the parity vector of its n-grams, under a random 64-bit
code for each position (equal vectors give equal words, unequal ones collide with chance 2^-64). One
n-gram in which two sets differ changes one cell, so the number of cells that differ is at most the symmetric difference, and
by the pigeonhole principle at least K - d cells agree. A set enters the join with its
cells of two or more n-grams. If those are at most its own largest d, it also enters with a second layout, and so on,
until a layout has more than d of them: then a linked partner shares at least one entered cell, and no
pair is lost. Cells of no or one n-gram, which unrelated texts share by chance or by a common phrase, never enter.

Join. Rows of one cell meet at the smallest member. In a task, members of one cell in a batch are first
reduced to that star, so a cell that a third of all texts share sends one row per batch. Star pairs that survive the size
test and a 1024-bit parity sketch, whose Hamming distance bounds the symmetric difference from below, are
verified on the whole sets. Members of a cell that end in different components are then paired across
components only (all but the cell's largest component, with everyone else), in blocks inside tasks and by the same
tests first; the pairs that pass are verified too, which makes the components exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import components, cut, free, hash_memo, mix64, n_partitions, run_folder, runs, steps, table, words_of

SKETCH_WORDS = 16
# Size bands grow by this factor at least, so that linked sets lie in one band or in neighbouring ones.
BAND = 1.5
# Packed rows leave a task about so many cells at a time.
CHUNK_CELLS = 1 << 20
# Members of a block where the members of a cell are compared.
BLOCK = 512
MISSING = -(1 << 63)


@dataclass(frozen=True)
class Measure:
    """n-gram length and the least Jaccard similarity as a fraction."""
    n: int = 4
    num: int = 85
    den: int = 100

    def __post_init__(self):
        if 4 * self.num < 3 * self.den or self.num > self.den:
            raise ValueError("the similarity must be from 0.75 to 1: below, cells of two n-grams cannot prove a link")

    def bands(self, largest: int) -> np.ndarray:
        """Least size of each band, up to one beyond ``largest``."""
        grow, lows = max(BAND, 1.02 * self.den / self.num), [1]
        while lows[-1] <= largest:
            lows.append(max(lows[-1] + 1, int(np.ceil(lows[-1] * grow))))
        return np.array(lows, np.int64)


def shingles(token_hashes: np.ndarray, lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text of a batch, sorted inside a text, and how many each has.

    A text of fewer than n words gives its whole word sequence as one n-gram; one without words gives none.
    """
    odd = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
    ends = np.cumsum(lengths)
    begins = ends - lengths
    total = int(ends[-1]) if len(ends) else 0
    grams = np.zeros(total, np.uint64)
    for j in range(min(n, total)):
        grams[:total - j] += mix64(token_hashes[j:] + odd[j % 8] * np.uint64(j // 8 + 1)) * odd[(j + 3) % 8]
    grams = mix64(grams)
    out, sizes = [], np.zeros(len(lengths), np.int64)
    for k, (a, b) in enumerate(zip(begins.tolist(), ends.tolist(), strict=True)):
        if b - a >= n:
            own = np.sort(grams[a:b - n + 1])
            own = own[runs(own)]
        elif b > a:
            own = np.array([b - a], np.uint64)
            for j in range(b - a):
                own = mix64(own * odd[j % 8] + token_hashes[a + j:a + j + 1])
        else:
            continue
        out.append(own)
        sizes[k] = len(own)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), sizes


def token_array(texts: list, memo) -> tuple[np.ndarray, np.ndarray]:
    words = [words_of(t) for t in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter((memo[w] for ws in words for w in ws), np.uint64, int(lengths.sum()))
    return flat, lengths


def parity_sketch(grams: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """One row of SKETCH_WORDS 64-bit words per text: bit b is the parity of the n-grams whose hash picks it."""
    bits = 64 * SKETCH_WORDS
    parity = np.bincount(owner * bits + (grams % np.uint64(bits)).astype(np.int64), minlength=count * bits) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64).reshape(count, SKETCH_WORDS)


def cells(grams: np.ndarray, sizes: np.ndarray, measure: Measure) -> tuple[np.ndarray, np.ndarray]:
    """(cell key, position of the text) of every cell that enters the join."""
    if not len(grams):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lows = measure.bands(int(sizes.max()) * measure.den // measure.num + 1)
    own = np.searchsorted(lows, sizes, side="right") - 1
    starts = np.cumsum(sizes) - sizes
    # a text joins as the larger set in its own band, and as the smaller one in the next if that is in reach
    reach = np.flatnonzero((sizes > 0) & (measure.den * sizes >= measure.num * lows[own + 1]))
    todo = np.concatenate([np.flatnonzero(sizes > 0), reach])
    band = np.concatenate([own[sizes > 0], own[reach] + 1])
    keys, texts, layout = [], [], 0
    code = mix64(grams)
    while len(todo):
        high = lows[band + 1] - 1
        widest = (measure.den - measure.num) * 2 * high // (measure.den + measure.num)
        wide = np.where(widest > 0, widest + 1 + (widest + 7) // 8, 1)
        # the text's own partners in this band are no larger than this
        partner = np.minimum(high, sizes[todo] * measure.den // measure.num)
        apart = (measure.den - measure.num) * (sizes[todo] + partner) // (measure.den + measure.num)
        n = sizes[todo]
        at = np.repeat(starts[todo] - np.cumsum(n) + n, n) + np.arange(n.sum())
        text = np.repeat(np.arange(len(todo)), n)
        pick = mix64(grams[at] ^ np.uint64(0x5851F42D4C957F2D + 2 * layout)) >> np.uint64(32)
        first = np.cumsum(wide) - wide
        cell = first[text] + ((pick * wide[text].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        total = int(wide.sum())
        word, filled = np.zeros(total, np.uint64), np.bincount(cell, minlength=total)
        np.bitwise_xor.at(word, cell, code[at])
        whole = np.repeat(widest == 0, wide)  # only equal sets link: one cell holds the set
        owner = np.repeat(np.arange(len(todo)), wide)
        enter = (filled >= 2) | whole
        number = np.arange(total) - first[owner]
        salt = ((band[owner].astype(np.uint64) << np.uint64(40)) + (np.uint64(layout) << np.uint64(32)) + number.astype(np.uint64)) * np.uint64(0xD1342543DE82EF95)
        keys.append(mix64(word[enter] ^ mix64(salt[enter])))
        texts.append(todo[owner[enter]])
        more = np.bincount(owner[enter], minlength=len(todo)) <= apart
        more &= widest > 0
        todo, band = todo[more], band[more]
        layout += 1
    return np.concatenate(keys), np.concatenate(texts)


ROWS = "bucket int, node bigint, doc_id bigint, n_shingles bigint, sketch array<bigint>, cell binary, member binary, lead binary"


def packed(bucket, cell, member, lead) -> pa.RecordBatch:
    n = len(bucket)
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64())),
         pa.array(cell, pa.binary()), pa.array(member, pa.binary()), pa.array(lead, pa.binary())],
        ["bucket", "node", "doc_id", "n_shingles", "sketch", "cell", "member", "lead"])


def star(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows by key and node, each once, with the smallest node under its key."""
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    keep = np.ones(len(key), bool)
    keep[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    key, node = key[keep], node[keep]
    first = runs(key)
    return key, node, np.repeat(node[first], np.diff(np.append(first, len(key))))


def sketch_rows(measure: Measure, buckets: int):
    """A row per document, and packed cells by bucket.

    Texts already seen in the task give no cells again. Of a cell's members in one chunk only the smallest
    goes to the cell's bucket; the others go, as a star around it, to buckets that take turns.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, seen, turn = hash_memo(), set(), 0
        keys, nodes, held = [], [], 0

        def flush():
            nonlocal turn
            key, node, lead = star(np.concatenate(keys), np.concatenate(nodes))
            out, star_rows = node == lead, node != lead
            bucket = (key[out] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            k, v, bucket = key[out][order], node[out][order], bucket[order]
            first = runs(bucket)
            cut_ = list(zip(first.tolist(), np.append(first[1:], len(bucket)).tolist(), strict=True))
            yield packed(bucket[first], [k[a:b].tobytes() for a, b in cut_], [v[a:b].tobytes() for a, b in cut_], [None] * len(cut_))
            if star_rows.any():
                parts = [np.array_split(x[star_rows], buckets) for x in (key, node, lead)]
                rows = [(b, *(p[b].tobytes() for p in parts)) for b in range(buckets) if len(parts[0][b])]
                yield packed([(r[0] + turn) % buckets for r in rows], *([r[i] for r in rows] for i in (1, 2, 3)))
                turn += 1

        for part in steps(batches):
            ids = part.column("node").to_numpy()
            grams, sizes = shingles(*token_array(part.column("text").to_pylist(), memo), measure.n)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            sketches = parity_sketch(grams, owner, len(sizes))
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array((ids.view(np.uint64) % np.uint64(buckets)).astype(np.int32)), part.column("node"), part.column("doc_id"), pa.array(sizes),
                 pa.ListArray.from_arrays(np.arange(0, SKETCH_WORDS * n + 1, SKETCH_WORDS, dtype=np.int32), sketches.ravel()),
                 *[pa.nulls(n, pa.binary())] * 3], ["bucket", "node", "doc_id", "n_shingles", "sketch", "cell", "member", "lead"])
            new = np.array([x not in seen and not seen.add(x) for x in ids.tolist()])
            use = new[owner]
            key, text = cells(grams[use], np.where(new, sizes, 0), measure)
            keys.append(key)
            nodes.append(ids[text])
            held += len(key)
            if held >= CHUNK_CELLS:
                yield from flush()
                keys, nodes, held = [], [], 0
        if held:
            yield from flush()
    return run


MEMBERS = "node bigint, doc_id bigint, n_shingles bigint, sketch array<bigint>, cell bigint, member bigint, lead bigint"


def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: documents pass through, stars too, and each bucket's cells are grouped.

    A cell with one member is dropped; the others give a row per member with the smallest one as lead.
    """
    names = ["node", "doc_id", "n_shingles", "sketch", "cell", "member", "lead"]
    now, keys, nodes = None, [], []

    def rows(key, node, lead):
        n = len(key)
        return pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64())),
                                           pa.array(key.view(np.int64)), pa.array(node), pa.array(lead)], names)

    def grouped():
        key, node, lead = star(np.concatenate(keys), np.concatenate(nodes))
        first = runs(key)
        size = np.diff(np.append(first, len(key)))
        keep = np.repeat(size > 1, size)
        return rows(key[keep], node[keep], lead[keep])

    for batch in batches:
        docs = batch.filter(pc.is_valid(batch.column("node")))
        if docs.num_rows:
            yield pa.RecordBatch.from_arrays([*(docs.column(c) for c in names[:4]), *[pa.nulls(docs.num_rows, pa.int64())] * 3], names)
        for k in np.flatnonzero(batch.column("cell").is_valid().to_numpy(zero_copy_only=False)).tolist():
            key, node = (np.frombuffer(batch.column(c)[k].as_buffer(), t) for c, t in (("cell", np.uint64), ("member", np.int64)))
            if batch.column("lead")[k].is_valid:
                yield rows(key, node, np.frombuffer(batch.column("lead")[k].as_buffer(), np.int64))
                continue
            bucket = batch.column("bucket")[k].as_py()
            if bucket != now and keys:
                yield grouped()
                keys, nodes = [], []
            now = bucket
            keys.append(key)
            nodes.append(node)
    if keys:
        yield grouped()


def set_rows(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = hash_memo()
        for part in steps(batches):
            grams, sizes = shingles(*token_array(part.column("text").to_pylist(), memo), n)
            yield pa.record_batch([part.column("node"), pa.ListArray.from_arrays(np.append(0, np.cumsum(sizes)).astype(np.int32), grams.view(np.int64))], ["node", "grams"])
    return run


PAIRS = "bucket int, pairs binary"


def likely_pairs(measure: Measure, buckets: int):
    """Rows of two blocks of one cell: pairs across components that sizes and sketches allow, packed by bucket."""
    def side(column, k):
        rows = column[k].values
        sketch = rows.field("sketch").flatten().to_numpy().view(np.uint64).reshape(-1, SKETCH_WORDS)  # unsigned, for bitwise_count
        return (*(rows.field(c).to_numpy() for c in ("member", "component", "n")), sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [np.zeros((0, 4), np.int64)], 0

        def flush():
            rows = np.unique(np.concatenate(held), axis=0)
            bucket = (mix64(rows[:, 0].view(np.uint64) + mix64(rows[:, 1].view(np.uint64))) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            first = runs(bucket[order])
            parts = np.split(rows[order], first[1:]) if len(first) else []
            return pa.record_batch([pa.array(bucket[order][first], pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], ["bucket", "pairs"])

        for batch in batches:
            for k in range(batch.num_rows):
                x, cx, nx, sx = side(batch.column("few"), k)
                y, cy, ny, sy = side(batch.column("everyone"), k)
                total = nx[:, None] + ny[None]
                apart = np.bitwise_count(sx[:, None] ^ sy[None]).sum(2, dtype=np.int64)
                test = cx[:, None] != cy[None]
                test &= measure.den * np.minimum(nx[:, None], ny[None]) >= measure.num * np.maximum(nx[:, None], ny[None])
                test &= apart * (measure.den + measure.num) <= (measure.den - measure.num) * total
                i, j = np.nonzero(test)
                if len(i):
                    swap = x[i] > y[j]
                    held.append(np.stack([np.where(swap, y[j], x[i]), np.where(swap, x[i], y[j]), np.where(swap, ny[j], nx[i]), np.where(swap, nx[i], ny[j])], 1))
                    count += len(i)
                    if count > CHUNK_CELLS:
                        held = [np.unique(np.concatenate(held), axis=0)]
                        count = len(held[0])
                        if count > CHUNK_CELLS // 2:
                            yield flush()
                            held, count = [np.zeros((0, 4), np.int64)], 0
        if count:
            yield flush()
    return run


def distinct_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each pair of a partition once."""
    rows = [np.frombuffer(x.as_buffer(), np.int64).reshape(-1, 4) for batch in batches for x in batch.column("pairs")]
    if rows:
        pairs = np.unique(np.concatenate(rows), axis=0)
        yield pa.record_batch([pa.array(np.ascontiguousarray(c)) for c in pairs.T], ["a", "b", "na", "nb"])


def node_of(docs: DataFrame) -> DataFrame:
    """(node, doc_id, text): a node is a 64-bit hash of the text, so equal texts are one node.

    Of n distinct texts, n^2 / 2^65 pairs are expected to share a node by chance.
    """
    return docs.select(F.xxhash64("text").alias("node"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")


class Join:
    """The steps of one join; each table is written to a folder of its own."""

    def __init__(self, docs: DataFrame, measure: Measure):
        self.docs, self.measure, self.spark = docs, measure, docs.sparkSession
        self.folder = run_folder(self.spark, "jaccard")

    def sketch(self) -> None:
        """``nodes`` (one row per row of the documents) and ``members`` (cell, member, lead)."""
        n = n_partitions(self.spark)
        buckets = 4 * n
        rows = node_of(self.docs).mapInArrow(sketch_rows(self.measure, buckets), ROWS).repartition(n, "bucket").sortWithinPartitions("bucket")
        rows = cut(rows.mapInArrow(gather, MEMBERS), self.folder, "members")
        self.rows = rows.where("node is not null").select("node", "doc_id", "n_shingles", "sketch")
        self.members = rows.where("cell is not null").select("cell", "member", "lead")
        self.nodes = cut(self.rows.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n"), F.min("sketch").alias("sketch")), self.folder, "nodes")

    def likely(self, pairs: DataFrame) -> DataFrame:
        """(a, b, na, nb) of the pairs whose sizes and parity sketches allow a link."""
        m = self.measure
        side = lambda s: self.nodes.select(F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("sketch").alias(f"s{s}"))
        apart = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
        test = (m.den * F.least("na", "nb") >= m.num * F.greatest("na", "nb")) & (apart * (m.den + m.num) <= (m.den - m.num) * (F.col("na") + F.col("nb")))
        return pairs.join(side("a"), "a").join(side("b"), "b").where(test).select("a", "b", "na", "nb")

    def verify(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs (a, b) that link, on their whole sets."""
        m = self.measure
        pairs = cut(pairs, self.folder, f"{name}-pairs")
        if pairs.isEmpty():
            return pairs.select("a", "b")
        wanted = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = wanted.join(self.nodes.select("node", "doc_id"), "node").select("node", F.coalesce("doc_id", F.lit(MISSING)).alias("did"))
        # by text and doc_id: copies of one text are spread, and one of them is read on
        texts = (node_of(self.docs).withColumn("did", F.coalesce("doc_id", F.lit(MISSING))).join(wanted, ["node", "did"], "left_semi").select("node", "text"))
        sets = texts.mapInArrow(set_rows(m.n), "node bigint, grams array<bigint>").groupBy("node").agg(F.first("grams").alias("grams"))
        sets = cut(sets, self.folder, f"{name}-sets")
        both = (pairs.join(sets.select(F.col("node").alias("b"), F.col("grams").alias("gb")), "b")
                .join(sets.select(F.col("node").alias("a"), F.col("grams").alias("ga")), "a"))
        common = F.size(F.array_intersect("ga", "gb"))
        return cut(both.where(m.den * common >= m.num * (F.col("na") + F.col("nb") - common)).select("a", "b"), self.folder, f"{name}-links")

    def classes(self) -> DataFrame:
        """(node, component) of every node that links with another text."""
        stars = self.members.where("member != lead").select(F.col("lead").alias("a"), F.col("member").alias("b")).distinct()
        stars = cut(stars, self.folder, "stars")
        links = self.verify(self.likely(stars), "star")
        found = cut(components(links, f"{self.folder}/first"), self.folder, "first-components")
        rest = self.across(found).join(stars, ["a", "b"], "left_anti")
        more = self.verify(rest, "rest")
        if more.isEmpty():
            return found
        return cut(components(links.unionAll(more), f"{self.folder}/second"), self.folder, "second-components")

    def across(self, found: DataFrame) -> DataFrame:
        """(a, b, na, nb): likely pairs of members of one cell in different components, each once.

        Every such pair has a member outside the cell's largest component. Those members meet all members in blocks
        of bounded size; only pairs that pass the size and parity tests leave a task, packed.
        """
        n = n_partitions(self.spark)
        everyone = self.members.select("cell", "member").unionAll(self.members.select("cell", F.col("lead").alias("member"))).distinct()
        named = everyone.join(found.withColumnRenamed("node", "member"), "member", "left").withColumn("component", F.coalesce("component", "member"))
        named = cut(named, self.folder, "named")
        size = named.groupBy("cell", "component").agg(F.count(F.lit(1)).alias("k"))
        split = (size.groupBy("cell").agg(F.count(F.lit(1)).alias("components"), F.sum("k").alias("k"), F.max(F.struct("k", "component")).alias("m")).where("components > 1")
                 .select("cell", F.ceil(F.col("k") / BLOCK).cast("int").alias("blocks"), F.col("m.component").alias("main")))
        info = self.nodes.select(F.col("node").alias("member"), "n", "sketch")
        rows = named.join(split, "cell").join(info, "member").withColumn("block", F.pmod(F.xxhash64("member"), "blocks").cast("int"))
        rows = cut(rows.select("cell", "block", "main", F.struct("member", "component", "n", "sketch").alias("r")), self.folder, "split-cells")
        everyone = rows.groupBy("cell", "block").agg(F.collect_list("r").alias("everyone"))
        few = rows.where("r.component != main").groupBy("cell", "block").agg(F.collect_list("r").alias("few"))
        packed_ = few.select("cell", "few").join(everyone.select("cell", "everyone"), "cell").mapInArrow(likely_pairs(self.measure, n), PAIRS)
        return packed_.repartition(n, "bucket").mapInArrow(distinct_pairs, "a bigint, b bigint, na bigint, nb bigint")


def classes(docs: DataFrame, measure: Measure = Measure()) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): (node, doc_id, n_shingles) per row and (node, component_id) per linked node."""
    join = Join(docs, measure)
    join.sketch()
    found = join.classes()
    least = found.join(join.nodes.select("node", "doc_id"), "node").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return join.rows.select("node", "doc_id", "n_shingles"), cut(found.join(least, "component").select("node", "component_id"), join.folder, "classes")


def link(docs: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row.

    Equal texts link, unless they have no words: null and empty texts have n_shingles 0 and their own
    doc_id as component_id, as has every row without links. Rows that repeat a doc_id each give a row by
    their own text. A null doc_id takes part; component_id is null only where all doc_ids in reach are. Other
    columns are not read. No rows give no rows.
    """
    rows, found = classes(docs, measure)
    own = rows.groupBy("node").agg(F.min("doc_id").alias("least"))  # copies of a text link with each other
    out = rows.join(found.join(own, "node", "right"), "node", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("component_id", "least")).alias("component_id"))


def op8_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents"))


def keep_one(docs: DataFrame, measure: Measure) -> DataFrame:
    """Pipeline stage: of each class the row with the smallest doc_id stays, all columns as they are.

    Rows without words stay all. Of rows alike in doc_id and text one stays; a class whose doc_ids are all null keeps
    one row.
    """
    rows, found = classes(docs, measure)
    named = rows.where("n_shingles > 0").join(found, "node", "left")
    # the class is named by component_id, or by the text where nothing else links
    group = F.when(F.col("component_id").isNotNull(), F.struct(F.lit(1).alias("kind"), F.col("component_id").alias("id"))).otherwise(F.struct(F.lit(0).alias("kind"), F.col("node").alias("id")))
    node, did = free(docs, "node"), free(docs, "did")
    best = named.groupBy(group.alias("g")).agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("b"))
    best = best.select(F.col("b.node").alias(node), F.coalesce("b.doc_id", F.lit(MISSING)).alias(did))
    keyed = docs.withColumn(node, F.xxhash64("text")).withColumn(did, F.coalesce(F.col("doc_id").cast("bigint"), F.lit(MISSING)))
    wordless = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = keyed.where(~wordless).join(best, [node, did], "left_semi").dropDuplicates([node, did])
    return kept.select(*docs.columns).unionAll(docs.where(wordless))
