"""Secret scanning over an incremental blob ledger.

A blob is a text under its SHA-256. The ledger has two tables below one folder: ``scanned``
(blob, rule, version), one row for each blob and rule version that was scanned, and ``findings``
(blob, rule, version, start, end). A scan reads the texts that some rule version has not seen, runs only the
missing rules on them, appends findings first and then the scanned marks, and joins findings back to
all paths. A job that dies between the two appends scans those blobs again; findings are read as a
set, so that changes nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import free, run_folder, steps, table
from tillstar.llm.token_counts import content, has_rows


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str
    version: int = 1
    # The match, or this group of it, must have at least ``least`` characters.
    group: int = 0
    least: int = 1
    # A text without any of these characters has no match (checked before the pattern runs).
    needs: str = ""


# The kinds, in the order in which equal starts are listed. A run that is matched whole
# carries its least length in the pattern, which finds the same runs faster.
RULES = (
    Rule("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 2, 8, ":="),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
FOUND = "digest binary, rule string, version int, start int, end int"


def find(text: str, rule: Rule, pattern: re.Pattern) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, as code point spans; those that are too short are dropped."""
    if rule.needs and not any(c in text for c in rule.needs):
        return []
    return [m.span() for m in pattern.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def scan_blobs(rules: tuple[Rule, ...]):
    """Rows of FOUND; a rule that was run gives one row with null start, its scanned mark, besides."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(r, re.compile(r.pattern)) for r in rules]
        for part in steps(batches):
            rows = []
            for digest, text, seen in zip(*(part.column(c).to_pylist() for c in ("digest", "text", "seen")), strict=True):
                for rule, pattern in compiled:
                    if f"{rule.name}:{rule.version}" in (seen or ()):
                        continue
                    rows.append((digest, rule.name, rule.version, None, None))
                    rows += [(digest, rule.name, rule.version, *span) for span in find(text, rule, pattern)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(list(zip(*rows, strict=True)) or [[]] * 5,
                                                      (pa.binary(), pa.string(), pa.int32(), pa.int32(), pa.int32()), strict=True)],
                ["digest", "rule", "version", "start", "end"])
    return run


def update_ledger(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger lacks and return its findings for ``rules``: (digest, rule, start, end)."""
    spark = docs.sparkSession
    asked = [f"{r.name}:{r.version}" for r in rules]
    blobs = content(docs).groupBy("digest").agg(F.first("text").alias("text"))
    if has_rows(spark, f"{ledger}/scanned"):
        scanned = spark.read.schema("digest binary, pair string").parquet(f"{ledger}/scanned")
        seen = scanned.where(F.col("pair").isin(asked)).groupBy("digest").agg(F.collect_set("pair").alias("seen"))
        todo = blobs.join(seen, "digest", "left").where(F.coalesce(F.size("seen"), F.lit(0)) < len(asked))
    else:
        todo = blobs.withColumn("seen", F.lit(None).cast("array<string>"))
    batch = run_folder(spark, "scan")
    todo.mapInArrow(scan_blobs(rules), FOUND).write.parquet(batch)
    rows = spark.read.schema(FOUND).parquet(batch)
    rows.where("start is not null").write.mode("append").parquet(f"{ledger}/findings")
    (rows.where("start is null").select("digest", F.concat_ws(":", "rule", "version").alias("pair"))
     .write.mode("append").parquet(f"{ledger}/scanned"))
    found = spark.read.schema(FOUND).parquet(f"{ledger}/findings")
    return (found.where(F.concat_ws(":", "rule", "version").isin(asked)).select("digest", "rule", "start", "end").distinct())


def findings_by_blob(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(digest, found): found is array<struct<start, kind, rule, end>> by start, then rule order."""
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.name, i)])
    return update_ledger(docs, ledger, rules).groupBy("digest").agg(F.array_sort(F.collect_list(F.struct(
        "start", order[F.col("rule")].alias("kind"), "rule", "end"))).alias("found"))


def scan(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, found), null ``found`` for a text without findings.

    Every row gets its text's findings; a null text is the empty one and has none. Repeated rows and
    copies each give a row, null doc_ids stay, other columns are not read. No rows give no rows.
    """
    found = findings_by_blob(docs, ledger, rules)
    return content(docs, "doc_id").select("doc_id", "digest").join(found, "digest", "left").drop("digest")


def cut_out(text, found, mark: str = "[SECRET]"):
    """``text`` with each span replaced by ``mark``; spans that overlap are replaced as one."""
    def step(acc, s):
        gap = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return (F.when(s["start"] >= acc["at"], F.struct(gap.alias("out"), s["end"].alias("at")))
                .otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    return F.aggregate(found, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def spans_text(found):
    return F.coalesce(F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", s["rule"], s["start"], s["end"]))), F.lit(""))


def op7_secret_scans(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), run_folder(spark, "blob-ledger"))
    count = lambda kind: F.coalesce(F.size(F.filter("found", lambda s: s["rule"] == kind)), F.lit(0)).cast("bigint")
    spans = spans_text(F.col("found"))
    return found.select("doc_id", *[count(r.name).alias(f"n_{r.name}") for r in RULES],
                        F.sha2(spans.cast("binary"), 256).alias("base_sha256"), spans.alias("spans"))


def redact(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All rows and columns of ``docs``; each found span becomes ``[SECRET]``, n_chars the new length.

    Rows without findings stay as they are, null texts included. Columns besides text and n_chars
    pass through under any name.
    """
    digest, spans = free(docs, "digest"), free(docs, "found")
    found = findings_by_blob(docs, ledger, rules).select(F.col("digest").alias(digest), F.col("found").alias(spans))
    keyed = docs.withColumn(digest, F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)))
    out = keyed.join(found, digest, "left")
    clean = F.when(F.col(spans).isNull(), F.col("text")).otherwise(cut_out(F.col("text"), F.col(spans)))
    out = out.withColumn("text", clean)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(length))
    return out.select(*docs.columns)
