"""Near-duplicate vectors by sorted projection passes.

Each pass draws random hyperplanes; a vector's hash is the concatenation of its signs, most significant
first, and the pass orders the vectors of a label lexicographically by it. Near vectors
share a beginning of their hashes and stand close together, so each vector is compared with the next
``window`` ones, and pairs at or above the threshold are links. Passes are independent;
their links are united and chained into components.

A window may miss a pair, the more so the more vectors of a label lie close. So all vectors of a label are then compared with each other
across components, in blocks of bounded size; a task sends on at most one link for each component it met. This makes the
components exact. It is quadratic in the size of a label.

A window is bounded, a group of copies is not. So the members of each component are then compared with
each other completely, in blocks of bounded size and without writing pairs: only counts
leave a task. ``n_links`` therefore holds every vector of the component within the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.llm.common import components, cut, n_partitions, run_folder, table
from tillstar.llm.vectors import dimension, matrix, usable

THRESHOLD = 0.98
PASSES = 16
# Passes of one Spark job: each multiplies the vectors that the job shuffles.
PASSES_PER_JOB = 4
BITS = 48
WINDOW = 48
# Vectors of a block in the complete comparison of a component, and of a label.
BLOCK, LABEL_BLOCK = 512, 1024
LINKS = "a bigint, b bigint"


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, from the components as they are."""
    return (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1))


def hashes(dim: int, passes: range, seed: int):
    """Rows (pass, label, code, id, v): each vector once for each pass of the job."""
    planes = {p: np.random.default_rng([seed, p]).standard_normal((dim, BITS)) for p in passes}
    weights = np.uint64(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("v"))
            for p in passes:
                code = ((x @ planes[p] > 0) * weights).sum(1, dtype=np.uint64).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), p, np.int32)), batch.column("label"), pa.array(code), batch.column("id"), batch.column("v")],
                                                 ["pass", "label", "code", "id", "v"])
    return run


def near(group: np.ndarray, ids: np.ndarray, x: np.ndarray, threshold: float, window: int, first_new: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows at most ``window`` apart of one group, the later one at ``first_new`` or after."""
    u = unit(x)
    left, right = [], []
    for gap in range(1, min(window, len(ids) - 1) + 1):
        lo = max(0, first_new - gap)
        a, b = slice(lo, len(ids) - gap), slice(lo + gap, len(ids))
        # the margin keeps every pair for the exact measure below
        hit = np.flatnonzero((group[a] == group[b]) & (np.einsum("ij,ij->i", u[a], u[b]) >= threshold - 1e-9)) + lo
        hit = hit[cosine(x[hit], x[hit + gap]) >= threshold]
        left.append(ids[hit])
        right.append(ids[hit + gap])
    return (np.concatenate(left), np.concatenate(right)) if left else (ids[:0], ids[:0])


def sweep(threshold: float, window: int):
    """Links inside one sorted partition, and its first and last ``window`` rows for the border.

    Rows come in order; the last ``window`` ones are carried into the next batch.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        group = np.zeros((0, 2), np.int64)
        ids, x = np.zeros(0, np.int64), None
        head = None
        none = pa.nulls

        def links(a, b):
            n = len(a)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), none(n, pa.int32()), none(n, pa.int32()), none(n, pa.int32()), none(n, pa.int64()), none(n, pa.int64()),
                                               none(n, pa.list_(pa.float64()))], names)

        def border(which, g, i, v):
            n = len(i)
            return pa.RecordBatch.from_arrays([none(n, pa.int64()), none(n, pa.int64()), pa.array(np.full(n, which, np.int32)), pa.array(np.full(n, part, np.int32)), pa.array(np.arange(n, dtype=np.int32)),
                                               pa.array(g[:, 0] * (1 << 40) + g[:, 1]), pa.array(i), pa.array(v.tolist(), pa.list_(pa.float64()))], names)

        names = ["a", "b", "side", "part", "pos", "grp", "id", "v"]
        for batch in batches:
            if not batch.num_rows:
                continue
            g = np.stack([batch.column("pass").to_numpy().astype(np.int64), batch.column("label").to_numpy().astype(np.int64)], 1)
            i, v = batch.column("id").to_numpy(), matrix(batch.column("v"))
            old = len(ids)
            group, ids = np.concatenate([group, g]), np.concatenate([ids, i])
            x = v if x is None else np.concatenate([x, v])
            key = group[:, 0] * (1 << 40) + group[:, 1]
            if head is None or len(head[1]) < window:
                head = (group[:window], ids[:window], x[:window]) if head is None else tuple(np.concatenate([h, n[old:][:window - len(head[1])]]) for h, n in zip(head, (group, ids, x), strict=True))
            a, b = near(key, ids, x, threshold, window, old)
            if len(a):
                yield links(*stars(a, b))
            group, ids, x = group[-window:], ids[-window:], x[-window:]
        if head is not None:
            yield border(0, *head)
            yield border(1, group, ids, x)
    return run


def across(threshold: float, window: int):
    """Links between the tail of a partition and the head of the next: rows sorted by join, side, pos."""
    def run(key: tuple, table_: pa.Table) -> pa.Table:
        table_ = table_.sort_by([("side", "descending"), ("pos", "ascending")])
        side = table_.column("side").to_numpy()
        tail = int((side == 1).sum())
        a, b = near(table_.column("grp").to_numpy(), table_.column("id").to_numpy(), matrix(table_.column("v").combine_chunks()), threshold, window, tail)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def passes_links(rows: DataFrame, dim: int, passes: range, folder: str, threshold: float, window: int, seed: int) -> DataFrame:
    """Links of some passes. Partitions hold ranges of (pass, label, hash); neighbours across a border meet too."""
    spark = rows.sparkSession
    hashed = rows.mapInArrow(hashes(dim, passes, seed), T.StructType([T.StructField("pass", T.IntegerType()), *rows.schema.fields[1:2], T.StructField("code", T.LongType()), *rows.schema.fields[:1], *rows.schema.fields[2:]]))
    order = ["pass", "label", "code", "id"]
    ranged = hashed.repartitionByRange(n_partitions(spark), *order).sortWithinPartitions(*order)
    found = cut(ranged.mapInArrow(sweep(threshold, window), "a bigint, b bigint, side int, part int, pos int, grp bigint, id bigint, v array<double>"), folder, f"pass-{passes.start}")
    border = found.where("side is not null").withColumn("join", F.col("part") + F.col("side"))
    met = border.groupBy("join").applyInArrow(across(threshold, window), LINKS)
    return cut(found.where("side is null").select("a", "b").unionAll(met), folder, f"links-{passes.start}")


def complete(threshold: float):
    """Counts per (vector of block i, block j): rows of block j within the threshold of it, itself counted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, times = batch.column("ids")[k].values.to_numpy(), batch.column("other_times")[k].values.to_numpy()
                x, y = (matrix(batch.column(c)[k].values) for c in ("vs", "other_vs"))
                close = unit(x) @ unit(y).T
                sure = close >= threshold + 1e-9
                for i, j in np.argwhere(~sure & (close >= threshold - 1e-9)):
                    sure[i, j] = cosine(x[i:i + 1], y[j:j + 1])[0] >= threshold
                yield pa.record_batch([pa.array(ids), pa.array(sure @ times.astype(np.int64))], ["id", "n"])
    return run


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few links as join the same nodes: each node with the smallest one that the links (a, b) reach."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j, low = at[:len(a)], at[len(a):], np.arange(len(nodes))
    while True:
        least, new = np.minimum(low[i], low[j]), low.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == low).all():
            keep = low != np.arange(len(nodes))
            return nodes[keep], nodes[low[keep]]
        low = new


def between(threshold: float):
    """Links of components over rows of two blocks of one label: every pair of vectors within the threshold across components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                cx, cy = (batch.column(c)[k].values.to_numpy() for c in ("components", "other_components"))
                x, y = (matrix(batch.column(c)[k].values) for c in ("vs", "other_vs"))
                u, w = unit(x), unit(y)
                a, b = cx[:0], cy[:0]
                for at in range(0, len(x), BLOCK):
                    # the margin keeps every pair for the exact measure below
                    i, j = np.nonzero((u[at:at + BLOCK] @ w.T >= threshold - 1e-9) & (cx[at:at + BLOCK, None] != cy[None]))
                    for part in range(0, len(i), 1 << 16):
                        m, n = i[part:part + (1 << 16)] + at, j[part:part + (1 << 16)]
                        sure = cosine(x[m], y[n]) >= threshold
                        a, b = stars(np.concatenate([a, cx[m[sure]]]), np.concatenate([b, cy[n[sure]]]))
                if len(a):
                    yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def across_components(rows: DataFrame, classes: DataFrame, folder: str, threshold: float) -> DataFrame:
    """Links between components, from all pairs of vectors of a label that lie in different ones."""
    size = rows.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / LABEL_BLOCK).cast("int").alias("blocks"))
    named = rows.join(classes, rows["id"] == classes["node"], "left").select("id", "label", "v", F.coalesce("component", "id").alias("component"))
    members = named.join(size, "label").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    blocks = cut(members.groupBy("label", "blocks", "block").agg(F.collect_list("component").alias("components"), F.collect_list("v").alias("vs")), folder, "label-blocks")
    other = blocks.select("label", F.col("block").alias("other"), F.col("components").alias("other_components"), F.col("vs").alias("other_vs"))
    pairs = blocks.withColumn("other", F.explode(F.sequence(F.col("block"), F.col("blocks") - 1))).join(other, ["label", "other"])
    return cut(pairs.select("components", "vs", "other_components", "other_vs").mapInArrow(between(threshold), LINKS), folder, "across")


def deduplicate(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
                threshold: float = THRESHOLD, passes: int = PASSES, window: int = WINDOW, seed: int = 4) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row.

    Vectors that are null, zero, or hold null or non-finite components, and those without label or
    id, link with nothing: n_links 0, and component_id is their own vec_id (null for a null one, kept then). Rows that
    repeat a vec_id are rows of their own: each is compared with every other row and gets its own result. Equal vectors
    of a label are one node with a count. Vectors of different lengths are an error. Other columns are not read. No rows
    give no rows.
    """
    spark = vectors.sparkSession
    folder = run_folder(spark, "vectors")
    named = vectors.select(F.col(id_col).cast("bigint").alias("vec"), F.col(label).cast("int").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    takes_part = usable("v") & F.col("label").isNotNull() & F.col("vec").isNotNull()
    named = cut(named.withColumn("row", F.monotonically_increasing_id()).withColumn("in", takes_part), folder, "rows")
    # a node: the equal vectors of a label, under the number of one of its rows
    nodes = cut(named.where("in").groupBy("label", "v").agg(F.min("row").alias("id"), F.count(F.lit(1)).alias("times"), F.min("vec").alias("least")), folder, "nodes")
    rows = nodes.select("id", "label", "v")
    dim = dimension(rows, "v")
    links = None
    for p in range(0, passes if dim else 0, PASSES_PER_JOB):
        found = passes_links(rows, dim, range(p, min(p + PASSES_PER_JOB, passes)), folder, threshold, window, seed)
        links = found if links is None else links.unionAll(found)
    if links is None:
        links = spark.createDataFrame([], LINKS)
    classes = cut(components(links, folder), folder, "components")
    more = across_components(rows, classes, folder, threshold)
    if not more.isEmpty():
        classes = cut(components(links.unionAll(more), f"{folder}/second"), folder, "second-components")
    # members in blocks: a hash deals a component's members, so no block or pair of blocks grows with it
    size = classes.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    members = nodes.join(classes, nodes["id"] == classes["node"]).join(size, "component").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    blocks = cut(members.groupBy("component", "blocks", "block").agg(*[F.collect_list(c).alias(f"{c}s" if c != "times" else c) for c in ("id", "times", "v")]), folder, "blocks")
    other = blocks.select("component", F.col("block").alias("other"), F.col("times").alias("other_times"), F.col("vs").alias("other_vs"))
    pairs = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(other, ["component", "other"])
    n = pairs.select("ids", "vs", "other_times", "other_vs").mapInArrow(complete(threshold), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    smallest = members.groupBy("component").agg(F.min("least").alias("smallest"))
    linked = members.select("id", "component").join(n, "id").join(smallest, "component").select("id", "n", "smallest")
    # nodes that no link joins: their own copies only
    result = nodes.join(linked, "id", "left").select("label", "v", F.coalesce("n", "times").alias("n"), F.coalesce("smallest", "least").alias("component"))
    found = named.where("in").join(result, ["label", "v"]).select("vec", (F.col("n") - 1).alias("n"), "component")
    out = found.unionAll(named.where("not in").select("vec", F.lit(0).cast("bigint"), "vec"))
    return (out.select(F.col("vec").alias(id_col), F.col("n").alias("n_links"), F.col("component").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))


def op4_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return deduplicate(table(spark, sf_dir, "embeddings"))
