"""Mixing sources to target weights by the cube method.

A source's target over its size is the number of times each of its words should be taken. The whole
part repeats every document; the fractional part is an inclusion probability, the same for all of
the source's documents. The flight phase moves probabilities along the null space of two constraints
(their sum, and their sum weighted by size), so document and word totals stay exact until at most two
documents are undecided. Documents are dealt by a hash into blocks of bounded size, each block flies
by itself, and its undecided documents fly again together until one block per source is left. Its flight
leaves out a few documents; these and the undecided ones land at the choice nearest to the totals.

Every random choice is seeded by the block, and a block's documents are put in a fixed order, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import WORD, cut, free, hashable, run_folder, table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
# Documents of a block in the flight phase.
BLOCK_DOCS = 20_000
# Documents of a source that are left to the landing, which tries all choices.
LANDING = 12
EDGE = 1e-9


def flight(prob: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Probabilities after the flight: all 0 or 1 but at most two.

    Three undecided documents span one direction that keeps both totals, the cross product of
    (1, 1, 1) and their sizes. The step goes to the nearer bound on either side, with chances that keep
    every expectation.
    """
    out = prob.tolist()
    sizes = size.tolist()
    draws = iter(rng.random(len(out) + 1).tolist())
    live: list[int] = []
    for k in range(len(out)):
        if EDGE < out[k] < 1 - EDGE:
            live.append(k)
        if len(live) < 3:
            continue
        i, j, m = live
        a, b, c = sizes[m] - sizes[j], sizes[i] - sizes[m], sizes[j] - sizes[i]
        if not (a or b or c):
            a, b, c = 1.0, -1.0, 0.0
        up = down = float("inf")
        for x, step in ((out[i], a), (out[j], b), (out[m], c)):
            if step > 0:
                up, down = min(up, (1 - x) / step), min(down, x / step)
            elif step < 0:
                up, down = min(up, x / -step), min(down, (1 - x) / -step)
        move = up if next(draws) * (up + down) < down else -down
        for x, step in ((i, a), (j, b), (m, c)):
            out[x] = min(1.0, max(0.0, out[x] + move * step))
        live = [x for x in live if EDGE < out[x] < 1 - EDGE]
    return np.array(out)


def land(prob: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Round the undecided documents (LANDING and two at most) to the choice nearest in words, then in documents.

    All choices are looked at; a document too many or too few counts as a fiftieth of the mean size.
    """
    undecided = np.flatnonzero((prob > EDGE) & (prob < 1 - EDGE))
    out = prob.copy()
    if len(undecided):
        choice = (np.arange(1 << len(undecided))[:, None] >> np.arange(len(undecided))) & 1
        words = np.abs(choice @ size[undecided] - prob[undecided] @ size[undecided])
        docs = np.abs(choice.sum(1) - prob[undecided].sum())
        out[undecided] = choice[np.argmin(words + docs * size[undecided].mean() / 50)]
    return np.round(out)


def fly(seed: int):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        level, block, blocks = int(group["level"].iloc[0]), int(key[1]), int(key[2])
        group = group.sort_values(["order", "size"], kind="stable").reset_index(drop=True)
        # the source's name enters the seed by its bytes
        rng = np.random.default_rng([seed, level, block, *(key[0] or "\0").encode("utf-8", "surrogatepass")])
        size = group["size"].to_numpy(np.float64)
        prob = group["prob"].to_numpy(np.float64).copy()
        if blocks == 1:  # the last documents stay out of the flight, for the landing
            prob[:-LANDING] = flight(prob[:-LANDING], size[:-LANDING], rng)
            prob = land(prob, size)
        else:
            prob = flight(prob, size, rng)
        return group.assign(prob=prob)[["row", "order", "source", "size", "prob", "level"]]
    return run


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, docs, source_size, target) from (source, docs, source_size), one row per source.

    Sources are ranked by code point (UTF-8 byte order), null last, and weigh ``weights`` in turn. A target
    beyond ``most`` times its source's size stops there, and the excess goes to the others by weight until
    none is above. Each round is one aggregate; only scalars reach the driver.
    """
    ranked = rank_sources(sources)
    weight = F.array(*[F.lit(float(w)) for w in weights])[(F.col("rank") % len(weights)).cast("int")]
    rows = ranked.withColumn("weight", weight).withColumn("limit", F.lit(float(most)) * F.col("source_size"))
    total = rows.agg(F.sum("source_size")).first()[0]
    if not total:
        return rows.select("source", "docs", "source_size", F.lit(0.0).alias("target"))
    goal, level, capped = share * float(total), 0.0, -1
    while True:
        over = F.col("limit") <= F.col("weight") * F.lit(level)
        limit, weigh, n = rows.agg(F.sum(F.when(over, F.col("limit")).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight"))),
                                   F.sum(over.cast("int"))).first()
        if n == capped or not weigh:
            break
        capped, level = n, (goal - limit) / weigh
    return rows.select("source", "docs", "source_size", F.least("limit", F.col("weight") * F.lit(level)).alias("target"))


def rank_sources(sources: DataFrame) -> DataFrame:
    """``rank`` from 0 by code point, null last, without bringing the sources into one task.

    Sources are numbered inside groups that share their first bytes; the groups' sizes give the shifts.
    """
    head = F.when(F.col("source").isNull(), F.lit("x")).otherwise(F.hex(F.substring("source", 1, 2).cast("binary")))
    rows = sources.withColumn("head", head)
    counts = rows.groupBy("head").agg(F.count(F.lit(1)).alias("c"))
    # one row per group of first bytes: bounded by the pairs of characters in use
    shift = counts.select("head", F.coalesce(F.sum("c").over(Window.orderBy("head").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("shift"))
    inner = rows.withColumn("n", F.row_number().over(Window.partitionBy("head").orderBy("source")) - 1)
    return inner.join(shift, "head").withColumn("rank", F.col("shift") + F.col("n")).drop("head", "n", "shift")


def mix(docs: DataFrame, seed: int = 10, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, block_docs: int = BLOCK_DOCS,
        identity: tuple[str | Column, ...] = ("doc_id", "source", "text")) -> DataFrame:
    """(row, order, doc_id, source, size, source_size, target, copies) of every row; ``copies`` is 0, 1 or 2.

    ``order`` is a hash of the ``identity`` columns; rows alike in them are each decided by themselves. Null texts have size 0; a null source is a source of its own, the last. Sources
    without words have target 0 and no copies. Other columns are not read. No rows give no rows.
    """
    spark = docs.sparkSession
    folder = run_folder(spark, "mixing")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"),
                       F.xxhash64(*identity).alias("order"), F.monotonically_increasing_id().alias("row"))
    rows = cut(rows, folder, "sizes")
    goals = cut(targets(rows.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size")), weights, share), folder, "targets")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # blocks follow from the source's number of documents, so that each holds about block_docs of them
    goals = goals.withColumn("times", times).withColumn("whole", F.floor("times").cast("int")).withColumn("prob", F.col("times") - F.col("whole"))
    same = rows["source"].eqNullSafe(goals["source"])
    live = rows.join(goals, same).where("size > 0").select("row", "order", rows["source"], rows["size"].cast("double").alias("size"), "prob", F.lit(0).alias("level"))
    decided, level = [], 0
    while True:
        n = live.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / block_docs).alias("blocks"))
        dealt = live.join(n.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
        dealt = dealt.withColumn("block", F.pmod(F.xxhash64("order", F.lit(level)), "blocks")).withColumn("level", F.lit(level))
        flown = dealt.groupBy("source", "block", "blocks").applyInPandas(fly(seed), "row bigint, order bigint, source string, size double, prob double, level int")
        flown = cut(flown, folder, f"flight-{level}")
        done = (F.col("prob") <= EDGE) | (F.col("prob") >= 1 - EDGE)
        decided.append(flown.where(done).select("row", F.round("prob").cast("int").alias("taken_part")))
        live = flown.where(~done)
        if live.isEmpty():
            break
        level += 1
    picks = decided[0]
    for more in decided[1:]:
        picks = picks.unionAll(more)
    out = rows.join(goals, same).select("row", "order", "doc_id", rows["source"], "size", "source_size", "target", "whole")
    return out.join(picks, "row", "left").withColumn("copies", F.when(F.col("size") > 0, F.col("whole") + F.coalesce("taken_part", F.lit(0))).otherwise(0)).drop("whole", "taken_part")


def repeat(docs: DataFrame) -> DataFrame:
    """Pipeline stage: each row as often as the mix takes it, all columns as they are.

    Rows alike in all columns are one text that is taken as often as they are together. Without a row
    number to join on, rows meet their copies by a hash of all columns.
    """
    order, copies, copy = free(docs, "order"), free(docs, "copies"), free(docs, "copy")
    taken = mix(docs, identity=tuple(hashable(docs))).groupBy(F.col("order").alias(order)).agg(F.sum("copies").cast("int").alias(copies)).where(F.col(copies) > 0)
    keyed = docs.withColumn(order, F.xxhash64(*hashable(docs))).join(taken, order).dropDuplicates([order])
    return keyed.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    m = mix(table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
