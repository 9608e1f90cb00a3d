"""Shards from a Feistel permutation of global row numbers.

Rows get global numbers 0..n-1 in the order of a digest of their content, so the numbers depend neither
on files nor on partitions. A Feistel network over a grid of about sqrt(n) x sqrt(n) cells permutes
them; a number that lands in one of the few cells beyond n walks on along its cycle until it is below
n. Permuted number p lies in shard ``p mod shards`` at slot ``p div shards``: shard sizes differ by one row
at most, slots have no gaps, and both follow from row number, n, number of shards and seed alone
(``place``), as does the row number from shard and slot (``row_at``).

DataFrame functions only. Equal rows are interchangeable: they travel as one row with a count until
the end, where they are dealt out in chunks, so copies never meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstar.llm.common import cut, free, run_folder, table

SHARDS = 8
SEED = "tillstar"
ROUNDS = 6
# Distinct rows that one bucket of the numbering holds on average; buckets whose sums are added up together.
BUCKET = 4096
TOGETHER_BITS = 10
# Equal rows that one task deals out at a time.
CHUNK = 10_000
# Steps of a walk; one that needs more fails the job (see ``permute``).
WALK = 64


def _div(x: Column, y: int) -> Column:
    return F.call_function("div", x, F.lit(y))


def grid(n: int) -> tuple[int, int]:
    """Sides a x b >= n of the grid, a = ceil(sqrt(n)); fewer than a cells lie beyond n."""
    a = max(1, int(n ** 0.5) - 1)
    while a * a < n:
        a += 1
    return a, max(1, -(-n // a))


def _network(x: Column, n: int, seed: str, sign: int) -> Column:
    """One pass of the network over the grid (``sign`` 1) or of its inverse (-1).

    Even rounds add a keyed draw from the right half to the left one, odd rounds the other way. A draw is
    the first 60 bits of the MD5 of ``seed:round:half``, modulo the side.
    """
    a, b = grid(n)

    def draw(turn: Column, half: Column, side: int) -> Column:
        digest = F.md5(F.concat(F.lit(f"{seed}:"), turn.cast("string"), F.lit(":"), half.cast("string")).cast("binary"))
        return F.lit(sign) * (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % F.lit(side))

    def turn_once(s: Column, turn: Column) -> Column:
        even = turn % 2 == 0
        left = F.when(even, F.pmod(s["left"] + draw(turn, s["right"], a), F.lit(a))).otherwise(s["left"])
        right = F.when(even, s["right"]).otherwise(F.pmod(s["right"] + draw(turn, s["left"], b), F.lit(b)))
        return F.struct(left.cast("long").alias("left"), right.cast("long").alias("right"))

    start = F.struct((x % F.lit(a)).cast("long").alias("left"), _div(x, a).cast("long").alias("right"))
    turns = F.array(*[F.lit(t) for t in list(range(ROUNDS))[::sign]])
    return F.aggregate(turns, start, turn_once, lambda s: s["left"] + s["right"] * F.lit(a))


def permute(x: Column, n: int, seed: str = SEED, sign: int = 1) -> Column:
    """The permutation of 0..n-1 (``sign`` 1) or its inverse (-1): the network with cycle walking.

    Fewer than a = ceil(sqrt(n)) cells lie beyond n and a walk meets each at most once, so 64 steps are
    enough for certain up to n = 4,096; beyond that each step leaves those cells with a chance of at least
    63/64. A walk that has not left them after 64 steps fails the job, it never gives a wrong place.
    """
    def further(acc: Column, _: Column) -> Column:
        return F.when(acc < n, acc).otherwise(_network(acc, n, seed, sign))

    first = F.transform(F.array(_network(x.cast("long"), n, seed, sign)), lambda p: F.when(p < n, p).otherwise(
        F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), p, further)))[0]
    return F.transform(F.array(first), lambda p: F.when(p < n, p).otherwise(F.raise_error(F.lit("a cycle walk needs more steps")).cast("long")))[0]


def place(row: Column, n: int, shards: int = SHARDS, seed: str = SEED) -> Column:
    """struct(shard, slot) of a row number, computed without any table."""
    return F.transform(F.array(permute(row, n, seed)), lambda p: F.struct((p % shards).cast("int").alias("shard"), _div(p, shards).alias("slot")))[0]


def row_at(shard: Column, slot: Column, n: int, shards: int = SHARDS, seed: str = SEED) -> Column:
    """The row number that lies at ``slot`` of ``shard``: the inverse of ``place``."""
    return permute(slot.cast("long") * shards + shard, n, seed, -1)


def number(rows: DataFrame, key: str, folder: str) -> tuple[DataFrame, int]:
    """Every row with its global number ``row`` (0..n-1, in the order of the digest ``key``), and n.

    Copies are counted first, partially before the shuffle. A prefix of the digest deals the distinct rows
    into buckets of about 4,096, numbered bucket by bucket; bucket sums are added up in two levels, so the
    one window without a key reads a row for every four million distinct rows.
    """
    n_key, n_count, n_bucket, n_super, n_start = (free(rows, x) for x in ("key", "count", "bucket", "super", "start"))
    groups = cut(rows.groupBy(F.col(key).alias(n_key), *[c for c in rows.columns if c != key]).agg(F.count(F.lit(1)).alias(n_count)), folder, "groups")
    distinct, n = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum(n_count), F.lit(0))).first()
    bits = min(32, (distinct // BUCKET).bit_length())
    groups = groups.withColumn(n_bucket, F.shiftright(F.conv(F.substring(n_key, 1, 8), 16, 10).cast("long"), 32 - bits))
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    sums = groups.groupBy(n_bucket).agg(F.sum(n_count).alias(n_count)).withColumn(n_super, F.shiftright(n_bucket, TOGETHER_BITS))
    supers = sums.groupBy(n_super).agg(F.sum(n_count).alias("s")).select(n_super, F.coalesce(F.sum("s").over(before().orderBy(n_super)), F.lit(0)).alias("s"))
    starts = (sums.withColumn("t", F.coalesce(F.sum(n_count).over(before(n_super).orderBy(n_bucket)), F.lit(0)))
              .join(supers, n_super).select(n_bucket, (F.col("s") + F.col("t")).alias(n_start)))
    others = [c for c in rows.columns if c != key]
    inside = before(n_bucket).orderBy(n_key, *others)
    groups = groups.withColumn(n_super, F.coalesce(F.sum(n_count).over(inside), F.lit(0))).join(starts, n_bucket).withColumn(n_start, F.col(n_start) + F.col(n_super))
    few = groups.where(F.col(n_count) <= CHUNK).withColumn("row", F.explode(F.sequence(n_start, F.col(n_start) + F.col(n_count) - 1)))
    many = (groups.where(F.col(n_count) > CHUNK).withColumn(n_super, F.explode(F.sequence(F.lit(0).cast("long"), _div(F.col(n_count) - 1, CHUNK))))
            .repartition(n_key, n_super).withColumn(n_start, F.col(n_start) + F.col(n_super) * CHUNK)
            .withColumn("row", F.explode(F.sequence(n_start, F.col(n_start) + F.least(F.lit(CHUNK).cast("long"), F.col(n_count) - F.col(n_super) * CHUNK) - 1))))
    out = few.select(*others, "row").unionAll(many.select(*others, "row"))
    return out, n


def deal(docs: DataFrame, shards: int = SHARDS, seed: str = SEED, folder: str | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, row, shard, slot): the place of every document.

    ``size`` is the UTF-8 bytes of the text plus 1. Row numbers follow the MD5 of ``doc_id:text``. Null
    doc_ids and texts read as empty in it; equal rows get places of their own each; an empty table gives no
    rows. Columns other than doc_id and text are not read, so their names cannot clash.
    """
    folder = folder or run_folder(docs.sparkSession, "shards")
    text = F.coalesce(F.col("text"), F.lit(""))
    thin = docs.select(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text).cast("binary")).alias("key"),
                       "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows, n = number(thin, "key", folder)
    return rows.withColumn("at", place(F.col("row"), n, shards, seed)).select("doc_id", "size", "text_crc32", "row", "at.shard", "at.slot")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: str = SEED) -> None:
    """Writes whole documents below ``path``, a folder ``shard=k`` each, rows sorted by ``slot``.

    Columns of the documents named shard or slot (in any case) are refused: they would be lost. A shard is
    written by as many tasks as its share of the slots needs (ranges of shard and slot), so files of a shard
    follow each other in slot order. Rows must be of orderable types.
    """
    clash = {c.lower() for c in docs.columns} & {"shard", "slot", "row"}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are names of the result")
    key = free(docs, "digest")
    content = F.concat_ws(":", *[F.coalesce(F.sha2(F.col(f"`{c}`").cast("string").cast("binary"), 256), F.lit("-")) for c in docs.columns])
    rows, n = number(docs.withColumn(key, F.md5(content.cast("binary"))), key, run_folder(docs.sparkSession, "shards"))
    at = place(F.col("row"), n, shards, seed)
    (rows.withColumn("row", at).select(*docs.columns, "row.shard", "row.slot").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.mode("errorifexists").partitionBy("shard").parquet(path))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = deal(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def oracle_sql() -> str:
    """DuckDB: row numbers by a plain sort, the same network, walks by recursion, CRC-32 by its table."""
    digest = "('0x' || substr(md5('{seed}:{k}:' || {half}), 1, 15))::BIGINT"

    def network(source: str, keep: str) -> str:
        sql = f"SELECT *, p % a AS l, p // a AS r FROM {source}"
        for k in range(ROUNDS):
            draw = digest.format(seed=SEED, k=k, half="r" if k % 2 == 0 else "l")
            sql = f"SELECT * REPLACE ((l + {draw} % a) % a AS l) FROM ({sql})" if k % 2 == 0 else f"SELECT * REPLACE ((r + {draw} % b) % b AS r) FROM ({sql})"
        return f"SELECT {keep}, l + r * a AS p, n, a, b FROM ({sql})"

    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([i] || range(8), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc FROM range(256) AS t(i)),
d AS (SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS hx FROM documents),
thin AS (
  SELECT doc_id, octet_length(encode(text))::BIGINT + 1 AS size, md5(coalesce(doc_id::VARCHAR, '') || ':' || text) AS key,
    xor(list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(hx, '..'), lambda h: ('0x' || h)::BIGINT),
      lambda c, x: xor(crc[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) AS text_crc32
  FROM d, crc_table),
sides AS (SELECT n, a, greatest(1, (n + a - 1) // a) AS b FROM (SELECT count(*) AS n, greatest(1, ceil(sqrt(count(*)))::BIGINT) AS a FROM thin)),
numbered AS (SELECT doc_id, size, text_crc32, row_number() OVER (ORDER BY key, doc_id) - 1 AS p, n, a, b FROM thin, sides),
walk AS ({network("numbered", "doc_id, size, text_crc32")}
  UNION ALL {network("(SELECT * FROM walk WHERE p >= n)", "doc_id, size, text_crc32")})
SELECT doc_id, size, text_crc32, 'rows' AS law, (p % {SHARDS})::INTEGER AS shard, (p // {SHARDS})::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM walk WHERE p < n"""
