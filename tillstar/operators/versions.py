"""Stored tables in versions: a load becomes visible whole, in one catalog step, or not at all (K1-K3).

A table ``db.t`` is a view over one external table ``db.t__v<version>``. The data of a version lie in a
folder of their own; its partitions point to that folder where the load wrote them, and to folders of
earlier versions where it did not. So an upsert writes only the partitions it touches, next to the old
ones, and then replaces the view. Readers see the old or the new version, never part of one; a job lost
at any point leaves the view as it was, and its folder is removed by ``vacuum``.

Tables may be bucketed and sorted by their key. The merge of a batch then reads the touched partitions
bucket by bucket and shuffles the batch only.

``remember`` keeps, beside the rows of an upsert's own files, what the join changed (``operators.upsert``). The
table does not show these columns; ``changes`` reads them, so tables derived from this one can follow it by
version number, each version once, whatever failed in between.

One writer a table at a time. Every version also leaves a manifest file (partition, folder, whether this
version wrote it) below the table's folder, which ``attach`` reads when a new session's catalog is empty.
"""

from __future__ import annotations

import json
import re
import time
import urllib.parse
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.operators.upsert import CHANGE, KEPT, UPDATED, merge_into, merges_rows, upsert, was
from tillstar.session import delete_folder, list_files, list_folders, read_small_file, reliable_checkpoint, write_small_file

PROPERTY = "tillstar.version"
# Partitions that one ALTER TABLE statement adds.
PER_STATEMENT = 500


@dataclass(frozen=True)
class Layout:
    """How a table is stored. ``partition_by`` must be functions of the key, never NULL; readers do not see ``hidden``."""
    partition_by: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0
    hidden: tuple[str, ...] = ()


def version_table(table: str, version: int) -> str:
    return f"{table}__v{version:06d}"


def current(spark: SparkSession, table: str) -> int:
    """The version that readers of ``table`` see; 0 if there is none."""
    if not spark.catalog.tableExists(table):
        return 0
    row = spark.sql(f"SHOW TBLPROPERTIES {table} ('{PROPERTY}')").first()
    if not row["value"].isdigit():
        raise ValueError(f"{table} exists but is not kept in versions")
    return int(row["value"])


def root(spark: SparkSession, table: str) -> str:
    db, name = table.split(".")
    return f"{spark.catalog.getDatabase(db).locationUri.rstrip('/')}/{name}__store"


# Manifests read so far, by path: they never change once complete.
_manifests: dict[str, list[dict]] = {}


def _manifest_path(spark: SparkSession, table: str, version: int) -> str:
    return f"{root(spark, table)}/versions/v{version:06d}.json"


def manifest(spark: SparkSession, table: str, version: int) -> list[dict]:
    """One row a partition of the version (spec, folder, fresh, ...): bounded by the number of partitions."""
    path = _manifest_path(spark, table, version)
    if path not in _manifests:
        if len(_manifests) >= 1000:
            _manifests.clear()
        _manifests[path] = [json.loads(line) for line in read_small_file(spark, path).splitlines()]
    return _manifests[path]


def stored_versions(spark: SparkSession, table: str) -> list[int]:
    """Versions whose manifest is there, whether a catalog knows them or not."""
    names = list_files(spark, f"{root(spark, table)}/versions")
    return sorted(int(n[1:7]) for n in names if re.fullmatch(r"v\d{6}\.json", n))


def read(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """A version of the table (the current one by default), partitions and buckets as stored."""
    return spark.table(version_table(table, current(spark, table) if version is None else version))


def _spec(partition_by: Sequence[str], row) -> str:
    """``a=1/b=x``: a partition's folder name, escaped as Spark escapes it."""
    return "/".join(f"{c}={_escaped(row[c])}" for c in partition_by)


def _escaped(value) -> str:
    text = str(value)
    return "".join(f"%{ord(ch):02X}" if ch in "\"#%'*/:=?\\\x7f{[]^" or ord(ch) < 32 else ch for ch in text)


def _partition_sql(spec: str) -> str:
    parts = [p.split("=", 1) for p in spec.split("/")]
    return "PARTITION (" + ", ".join(f"`{c}` = '{_quoted(urllib.parse.unquote(v))}'" for c, v in parts) + ")"


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _write(df: DataFrame, table: str, version: int, layout: Layout) -> tuple[str, list[str]]:
    """Writes the rows of a new version into a folder of its own. Returns it and the partitions written."""
    spark = df.sparkSession
    folder = f"{root(spark, table)}/data/v={version:06d}-{uuid.uuid4().hex[:8]}"
    writer = df.hint("rebalance", *layout.partition_by) if layout.partition_by and not layout.buckets else df
    writer = writer.write.format("parquet").mode("errorifexists").option("path", folder)
    if layout.partition_by:
        writer = writer.partitionBy(*layout.partition_by)
    if layout.buckets:
        writer = writer.bucketBy(layout.buckets, *layout.bucket_by).sortBy(*layout.bucket_by)
    staging = f"{table}__writing_{uuid.uuid4().hex[:8]}"
    writer.saveAsTable(staging)
    specs = [r[0] for r in spark.sql(f"SHOW PARTITIONS {staging}").collect()] if layout.partition_by else [""]
    spark.sql(f"DROP TABLE {staging}")           # external: the files stay
    return folder, specs


def _define(spark: SparkSession, table: str, version: int, columns: str, layout: Layout, parts: dict[str, str]) -> None:
    """The catalog entry of a version. Nobody reads it before the switch."""
    name = version_table(table, version)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    ddl = f"CREATE TABLE {name} ({columns}) USING parquet"
    if layout.partition_by:
        ddl += f" PARTITIONED BY ({', '.join(f'`{c}`' for c in layout.partition_by)})"
    if layout.buckets:
        by = ", ".join(f"`{c}`" for c in layout.bucket_by)
        ddl += f" CLUSTERED BY ({by}) SORTED BY ({by}) INTO {layout.buckets} BUCKETS"
    nowhere = f"{root(spark, table)}/none"
    spark.sql(f"{ddl} LOCATION '{_quoted(parts.get('', nowhere))}'")
    specs = [s for s in parts if s]
    for at in range(0, len(specs), PER_STATEMENT):
        spark.sql(f"ALTER TABLE {name} ADD " + " ".join(f"{_partition_sql(s)} LOCATION '{_quoted(parts[s])}'" for s in specs[at:at + PER_STATEMENT]))


def _switch(spark: SparkSession, table: str, version: int, hidden: Sequence[str] = ()) -> None:
    """The one step that makes a version visible."""
    shown = ", ".join(f"`{c}`" for c in spark.table(version_table(table, version)).columns if c not in hidden)
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('{PROPERTY}' = '{version}') AS SELECT {shown} FROM {version_table(table, version)}")


def _publish(spark: SparkSession, table: str, version: int, columns: str, layout: Layout, parts: dict[str, str], fresh: set[str], kind: str,
             follows: dict[str, int] | None = None) -> None:
    rest = {"kind": kind, "columns": columns, "written_at": time.time(), "follows": follows or {}, "base": current(spark, table)}
    rows = [{"spec": spec, "folder": folder, "fresh": spec in fresh, **rest} for spec, folder in parts.items()]
    rows += [{"spec": spec, "folder": None, "fresh": True, **rest} for spec in fresh - set(parts)]      # partitions that are gone
    rows = rows or [{"spec": None, "folder": None, "fresh": False, **rest}]
    write_small_file(spark, _manifest_path(spark, table, version), "\n".join(json.dumps(r) for r in rows))
    _define(spark, table, version, columns, layout, parts)
    _switch(spark, table, version, layout.hidden)


def followed(spark: SparkSession, table: str) -> dict[str, int]:
    """The versions of other tables that the current version of a derived table takes account of."""
    now = current(spark, table)
    return manifest(spark, table, now)[0]["follows"] if now else {}


def _next(spark: SparkSession, table: str) -> int:
    return max([current(spark, table), *stored_versions(spark, table)]) + 1


def _parts(spark: SparkSession, table: str, version: int) -> dict[str, str]:
    return {r["spec"]: r["folder"] for r in manifest(spark, table, version) if r["folder"] is not None}


def _columns(schema: T.StructType, declared: str | None) -> str:
    return declared or ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def replace(spark: SparkSession, table: str, df: DataFrame, layout: Layout = Layout(), declared: str | None = None,
            follows: dict[str, int] | None = None) -> int:
    """K1: a new version with the rows of ``df`` only. Returns its number. ``declared``: column list of the DDL;
    ``follows``: what ``followed`` tells later, switched in with the rows."""
    version = _next(spark, table)
    old = _parts(spark, table, current(spark, table)) if current(spark, table) else {}
    if layout.buckets:
        df = df.repartition(layout.buckets, *layout.bucket_by)
    folder, specs = _write(df, table, version, layout)
    parts = {s: f"{folder}/{s}".rstrip("/") for s in specs}
    _publish(spark, table, version, _columns(df.schema, declared), layout, parts, set(parts) | set(old), "replace", follows)
    return version


def rewrite(spark: SparkSession, table: str, touched: DataFrame | None, merge: Callable[[DataFrame], DataFrame], layout: Layout, kind: str = "rewrite",
            follows: dict[str, int] | None = None) -> int:
    """A new version in which the partitions named by the rows of ``touched`` (partition columns; None: all) hold what
    ``merge`` makes of their old rows. The other partitions keep their files. ``touched`` is read as one row a partition."""
    version, now = _next(spark, table), current(spark, table)
    schema = spark.table(version_table(table, now)).schema
    parts = _parts(spark, table, now)
    target = read(spark, table, now)
    old = set(parts)
    if touched is not None and layout.partition_by:
        rows = touched.select(*layout.partition_by).distinct().collect()
        if any(v is None for r in rows for v in r):
            raise ValueError(f"{table}: NULL partition value")
        if not rows:
            if follows is not None and follows != followed(spark, table):
                _publish(spark, table, version, _columns(schema, None), layout, parts, set(), kind, follows)
                return version
            return now
        old = {_spec(layout.partition_by, r) for r in rows}
        target = target.where(any_of(layout.partition_by, rows))
    merged = merge(target)
    folder, specs = _write(merged, table, version, layout)
    written = {s: f"{folder}/{s}".rstrip("/") for s in specs}
    kept = {s: f for s, f in parts.items() if s not in old and s not in written}
    _publish(spark, table, version, _columns(schema, None), layout, kept | written, set(written) | (old & set(parts)), kind, follows)
    return version


def any_of(columns: Sequence[str], rows) -> Column:
    """A predicate on partition columns that the scan prunes by: the last column's values listed for each of the others."""
    groups: dict[tuple, list] = {}
    for r in rows:
        groups.setdefault(tuple(r[c] for c in columns[:-1]), []).append(r[columns[-1]])
    out = None
    for head, last in groups.items():
        one = F.col(columns[-1]).isin(last)
        for c, v in zip(columns, head):
            one = one & (F.col(c) == F.lit(v))
        out = one if out is None else out | one
    return out


def upsert_versioned(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
                     layout: Layout = Layout(), remember: Sequence[str] = (), whole: bool = False,
                     follows: dict[str, int] | None = None) -> int:
    """K3, all or nothing, in one interface: a table of a catalog that merges rows itself (``merges_rows``) gets a MERGE
    command and gives version 0; all others are merged by a join. There, the partitions that ``source`` touches are merged and written anew, the rest is kept.

    ``whole``: the source is known to touch every partition, so it is not read once before to see which. A source
    with a duplicate or NULL key fails, as does a NULL partition value; nothing becomes visible then."""
    if merges_rows(spark, table):
        merge_into(source, table, keys, update_cols)
        return 0
    for c in layout.partition_by:
        source = source.withColumn(c, F.coalesce(F.col(c), F.raise_error(F.lit(f"{table}.{c}: NULL partition value")).cast(source.schema[c].dataType)))
    if not current(spark, table):
        version = _next(spark, table)
        merged = upsert(spark.createDataFrame([], source.schema), source, keys, update_cols, remember)
        if layout.buckets:
            merged = merged.repartition(layout.buckets, *layout.bucket_by)
        folder, specs = _write(merged, table, version, layout)
        parts = {s: f"{folder}/{s}".rstrip("/") for s in specs}
        _publish(spark, table, version, _columns(source.schema, None), layout, parts, set(parts), "upsert" if remember else "replace", follows)
        return version
    batch = source if whole or not layout.partition_by else reliable_checkpoint(source)
    return rewrite(spark, table, None if whole else batch, lambda target: upsert(target, batch, keys, update_cols, remember), layout,
                   "upsert" if remember else "rewrite", follows)


def replace_partitions(spark: SparkSession, table: str, df: DataFrame, touched: DataFrame | None, layout: Layout,
                       follows: dict[str, int] | None = None) -> int:
    """The partitions named by ``touched`` (None: all) hold the rows of ``df`` and nothing else (one without rows goes)."""
    if not current(spark, table):
        return replace(spark, table, df, layout, follows=follows)
    return rewrite(spark, table, touched, lambda target: df.select(*target.columns), layout, follows=follows)


def has_batch(spark: SparkSession, table: str, batch_id: str) -> bool:
    return _spec(("batch_id",), {"batch_id": batch_id}) in _parts(spark, table, current(spark, table))


def append_once(spark: SparkSession, table: str, df: DataFrame, batch_id: str) -> bool:
    """K2 for a table without a key, exactly once: the rows are the partition ``batch_id`` of the table, which is also
    the ledger. A batch id that the table has adds nothing. Returns whether rows were added."""
    layout = Layout(("batch_id",), hidden=("batch_id",))
    rows = df.withColumn("batch_id", F.lit(batch_id))
    now = current(spark, table)
    if now and has_batch(spark, table, batch_id):
        return False
    version, schema = _next(spark, table), read(spark, table).schema if now else rows.schema
    folder, specs = _write(rows.select(*schema.fieldNames()), table, version, layout)
    if not specs:                               # an empty batch: note it all the same
        specs = [_spec(("batch_id",), {"batch_id": batch_id})]
    written = {s: f"{folder}/{s}" for s in specs}
    _publish(spark, table, version, _columns(schema, None), layout, (_parts(spark, table, now) if now else {}) | written, set(written), "append")
    return True


def since(spark: SparkSession, table: str, after: int) -> list[list[dict]] | None:
    """Manifests of the versions that led from ``after`` to the current one, oldest first; None if they are not all
    kept. A version that was lost before its switch led to none and is not among them."""
    out, version, kept = [], current(spark, table), set(stored_versions(spark, table))
    while version > after:
        if version not in kept:
            return None
        out.append(manifest(spark, table, version))
        version = out[-1][0]["base"]
    return out[::-1] if version == after else None


def fresh(spark: SparkSession, table: str, after: int) -> tuple[set[str] | None, bool]:
    """Partitions (``a=1/b=2``) that versions after ``after`` wrote or removed (None: their manifests are gone), and
    whether each of those versions tells what it changed row by row (``remember``)."""
    steps = since(spark, table, after)
    if steps is None:
        return None, False
    return {r["spec"] for rows in steps for r in rows if r["fresh"]}, all(r["kind"] == "upsert" for rows in steps for r in rows)


def changes(spark: SparkSession, table: str, after: int, columns: Sequence[str], remember: Sequence[str]) -> DataFrame:
    """(``columns``, ``sign``): rows that versions after ``after`` took out (-1) and put in (+1).

    Read from the files those versions wrote, and only rows that an upsert named. ``remember`` columns have their
    old values in rows taken out; the other columns are those of the key, which never change."""
    schema = read(spark, table).schema
    out = spark.createDataFrame([], T.StructType([schema[c] for c in columns] + [T.StructField("sign", T.IntegerType(), False)]))
    for rows in since(spark, table, after) or []:
        for folder in sorted({data_folder(r["folder"], r["spec"]) for r in rows if r["fresh"] and r["folder"]}):
            told = spark.read.parquet(folder).where(F.col(CHANGE) != KEPT)
            new = told.select(*columns, F.lit(1).alias("sign"))
            old = told.where(F.col(CHANGE) == UPDATED).select(*[F.col(was(c) if c in remember else c).alias(c) for c in columns], F.lit(-1).alias("sign"))
            out = out.unionByName(new).unionByName(old)
    return out


def changed_keys(spark: SparkSession, table: str, after: int, keys: Sequence[str], remember: Sequence[str]) -> DataFrame:
    """Keys of rows that versions after ``after`` inserted, or updated in one of the ``remember`` columns."""
    same = changes(spark, table, after, [*keys, *remember], remember).groupBy(*keys, *remember).agg(F.sum("sign").alias("net"))
    return same.where("net != 0").select(*keys).distinct()


def data_folder(folder: str, spec: str) -> str:
    return folder[: -len(spec) - 1] if spec else folder


def attach(spark: SparkSession, table: str, layout: Layout = Layout()) -> int:
    """Enter a stored table into a catalog that does not know it (a new session without a metastore)."""
    versions = stored_versions(spark, table)
    if not versions or current(spark, table) == versions[-1]:
        return current(spark, table)
    rows = manifest(spark, table, versions[-1])
    _define(spark, table, versions[-1], rows[0]["columns"], layout, {r["spec"]: r["folder"] for r in rows if r["folder"] is not None})
    _switch(spark, table, versions[-1], layout.hidden)
    return versions[-1]


def vacuum(spark: SparkSession, table: str, keep: int = 2, older_than_seconds: float = 86_400) -> list[int]:
    """Forget all versions but the last ``keep``, once they were superseded ``older_than_seconds`` ago (longer than any
    run reads one), and remove data folders that no kept version points to, those of lost jobs included. Returns the
    versions forgotten."""
    def long_ago(then: float) -> bool:
        return time.time() - then >= older_than_seconds

    now, versions = current(spark, table), stored_versions(spark, table)
    manifests = {v: manifest(spark, table, v) for v in versions}
    written = {v: min(r["written_at"] for r in rows) for v, rows in manifests.items()}
    superseded = {v: min((written[w] for w in versions if v < w <= now), default=time.time()) for v in versions}
    old = [v for v in versions if v <= now - keep and long_ago(superseded[v]) or v > now and long_ago(written[v])]
    used = {data_folder(r["folder"], r["spec"]).rsplit("/", 1)[1] for v, rows in manifests.items() if v not in old for r in rows if r["folder"]}
    for v in old:
        spark.sql(f"DROP TABLE IF EXISTS {version_table(table, v)}")
        delete_folder(spark, _manifest_path(spark, table, v))
        _manifests.pop(_manifest_path(spark, table, v), None)
    for name, changed in list_folders(spark, f"{root(spark, table)}/data"):
        if name not in used and long_ago(changed):
            delete_folder(spark, f"{root(spark, table)}/data/{name}")
    return old


def specs_frame(spark: SparkSession, specs: set[str], layout: Layout, schema: T.StructType) -> DataFrame:
    """Partition names as rows of the partition columns."""
    rows = [tuple(urllib.parse.unquote(p.split("=", 1)[1]) for p in s.split("/")) for s in sorted(specs)]
    text = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in layout.partition_by))
    return text.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in layout.partition_by])

