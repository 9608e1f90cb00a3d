"""File sources S1-S6 and U1, plus writers that lay data out the way those sources expect.

Every reader takes an ordered list of paths (the ingest job's file list) and can record the
read position of each row in the columns of ``READ_ORDER``, so that "the last row" of a
concatenation is well defined on a cluster (see ``operators.dedup.keep_last``):

* ``_file_ordinal``: position of the file in the caller's list (0 when a folder was given),
* ``_file_path``: file name, breaks ties between files of one folder,
* ``_split_start``: byte offset of the split inside the file,
* ``_row_id``: ``monotonically_increasing_id()`` taken directly after the scan, increasing
  inside a split,
* ``_in_row``: position inside a column-oriented document (0 for row formats).

All readers take an explicit schema: no inference pass, and text columns such as zip codes
keep their leading zeros.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.sources import avro

# Microsecond text form of TIMESTAMP_NTZ in JSON (Spark's default writes milliseconds only).
NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

READ_ORDER = ("_file_ordinal", "_file_path", "_split_start", "_row_id", "_in_row")

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:/*"


def _norm_path(c: Column) -> Column:
    return F.regexp_replace(c, _SCHEME, "/")


def _norm_path_py(p: str) -> str:
    return re.sub(_SCHEME, "/", p) if re.match(_SCHEME, p) else p


def _as_list(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def with_read_position(df: DataFrame, paths: Sequence[str], in_row: Column | None = None,
                       meta: str = "_metadata") -> DataFrame:
    """Add the ``READ_ORDER`` columns. Must be applied directly on a file scan; ``meta`` names
    the file metadata struct (the hidden ``_metadata`` column, or a copy of it)."""
    # Spark reports paths as encoded URIs; the caller's list is encoded by the same class
    uri = df.sparkSession._jvm.org.apache.hadoop.fs.Path
    ordinals = {_norm_path_py(uri(p).toUri().toString()).rstrip("/"): i for i, p in enumerate(paths)}
    fpath = _norm_path(F.col(f"{meta}.file_path"))
    if ordinals:
        # a literal map of the caller's file list: bounded by the list, not by the data
        ordmap = F.create_map(*[x for k, v in ordinals.items() for x in (F.lit(k), F.lit(v))])
        # the file itself or, where a folder is listed, its folder
        ordinal = F.coalesce(F.try_element_at(ordmap, fpath), F.try_element_at(ordmap, F.regexp_replace(fpath, "/[^/]*$", F.lit(""))),
                             F.raise_error(F.concat(F.lit("file is not in the source's list: "), fpath)).cast("int"))
    else:
        ordinal = F.lit(0)
    return (df.withColumn("_file_ordinal", ordinal)
              .withColumn("_file_path", fpath)
              .withColumn("_split_start", F.col(f"{meta}.file_block_start"))
              .withColumn("_row_id", F.monotonically_increasing_id())
              .withColumn("_in_row", in_row if in_row is not None else F.lit(0)))


# ---------------------------------------------------------------- S2 / S5: CSV
def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
             index_column: bool = True, header: bool = True, positions: bool = False, multiline: bool = False) -> DataFrame:
    """Multi-file CSV with a header row. ``multiline``: quoted fields may hold line breaks. ``index_column``: the files start with an unnamed
    index column (written by a pandas ``to_csv``); it is read and dropped (P1)."""
    paths = _as_list(paths)
    fields = ([T.StructField("_index", T.LongType())] if index_column else []) + list(schema.fields)
    df = (spark.read.schema(T.StructType(fields)).option("header", header)
          # a quote inside a quoted field is doubled; all columns are parsed, so a short row fails
          .option("escape", '"').option("multiLine", multiline).option("columnPruning", False)
          .option("mode", "FAILFAST").csv(paths))
    if positions:
        df = with_read_position(df, paths)
    return df.drop("_index")


def write_csv(df: DataFrame, path: str, num_files: int, index_column: bool = True) -> None:
    """CSV files with a header and, optionally, an unnamed leading index column."""
    out = df
    if index_column:
        out = df.select(F.monotonically_increasing_id().alias(""), *df.columns)
    out.repartition(num_files).write.mode("overwrite").option("header", True).csv(path)


# ---------------------------------------------------------------- S3: JSON records
def read_json_records(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
                      positions: bool = False, multiline: bool = False) -> DataFrame:
    """JSON with one object per row (``orient='records'`` / JSON lines)."""
    paths = _as_list(paths)
    # timestamps arrive as text (Spark, ISO) or as epoch milliseconds (pandas' default): read as text
    ts = [f.name for f in schema.fields if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType))]
    text_schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name in ts else f for f in schema.fields])
    df = spark.read.schema(text_schema).option("mode", "FAILFAST").option("multiLine", multiline).json(paths)
    if positions:
        df = with_read_position(df, paths)
    return df.select(*[_timestamp_text(F.col(c), schema[c].dataType).alias(c) if c in ts else F.col(c)
                       for c in df.columns])


def write_json_records(df: DataFrame, path: str, num_files: int) -> None:
    df.repartition(num_files).write.mode("overwrite").option("timestampNTZFormat", NTZ_FORMAT).json(path)


# ---------------------------------------------------------------- S1 / S3: column-oriented JSON
def _zip_columns(names: Sequence[str]) -> Column:
    """map<label, struct<names...>> aligned by label; a label missing in a column -> NULL."""
    first, rest = names[0], names[1:]
    if not rest:
        return F.transform_values(F.col(first), lambda k, v: F.struct(v.alias(first)))
    acc = F.map_zip_with(F.col(first), F.col(rest[0]),
                         lambda k, a, b: F.struct(a.alias(first), b.alias(rest[0])))
    done = [first, rest[0]]
    for name in rest[1:]:
        acc = F.map_zip_with(acc, F.col(name), _add_field(list(done), name))
        done.append(name)
    return acc


def _add_field(prev: list[str], name: str):
    """(label, struct of ``prev``, value) -> struct of ``prev`` + ``name``."""
    return lambda k, s, v: F.struct(*[s[p].alias(p) for p in prev], v.alias(name))


def read_json_columns(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
                      positions: bool = False, multiline: bool = False) -> DataFrame:
    """Column-oriented JSON documents: ``{"col": {"label": value, ...}, ...}``.

    Each document (one per line, or one per file with ``multiline``) is read as a row of maps;
    the maps are merged by label with ``map_zip_with`` (hash lookup, no shuffle) and exploded
    in document order. Columns are the fields of ``schema``.
    """
    paths = _as_list(paths)
    names = [f.name for f in schema.fields]
    # timestamps arrive as text (Spark, ISO) or as epoch milliseconds (pandas' default): read as text
    is_ts = {f.name: isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)) for f in schema.fields}
    doc_schema = T.StructType([T.StructField(f.name, T.MapType(T.StringType(),
                                                               T.StringType() if is_ts[f.name] else f.dataType))
                               for f in schema.fields])
    docs = spark.read.schema(doc_schema).option("mode", "FAILFAST").option("multiLine", multiline).json(paths)
    if positions:
        docs = with_read_position(docs, paths).drop("_in_row")
    keep = [c for c in READ_ORDER if c != "_in_row"] if positions else []
    rows = docs.select(*keep, F.posexplode(_zip_columns(names)).alias("_in_row", "_label", "_r"))
    cols = [(_timestamp_text(F.col("_r")[f.name], f.dataType) if is_ts[f.name] else F.col("_r")[f.name]).alias(f.name)
            for f in schema.fields]
    return rows.select(*keep, *(["_in_row"] if positions else []), *cols)


def _timestamp_text(c: Column, dtype: T.DataType) -> Column:
    """ISO text -> timestamp; all-digit text -> time since 1970 (wall clock in UTC), in the first of seconds,
    milliseconds, microseconds and nanoseconds that stays within 64-bit nanoseconds, as pandas reads it."""
    number = c.cast("decimal(20,0)")
    most = F.lit(9223372036).cast("decimal(20,0)")
    per_second = (F.when(F.abs(number) <= most, F.lit(1)).when(F.abs(number) <= most * 1000, F.lit(1000))
                  .when(F.abs(number) <= most * 1000000, F.lit(1000000)).otherwise(F.lit(1000000000)))
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(
        secs=(number / per_second.cast("decimal(10,0)")).cast("decimal(18,6)"))
    ntz = F.when(c.rlike("^-?[0-9]+$"), epoch).otherwise(F.to_timestamp_ntz(c))
    return ntz.cast(dtype)


def write_json_columns(df: DataFrame, path: str, num_files: int) -> None:
    """Write column-oriented JSON, one document per Arrow batch (labels 0..n-1 per document).

    The document of one batch is built by pandas inside the task; batches are bounded by
    ``spark.sql.execution.arrow.maxRecordsPerBatch``.
    """
    def to_docs(batches):
        import pandas as pd
        for pdf in batches:
            if len(pdf):
                pdf = pdf.reset_index(drop=True)
                yield pd.DataFrame({"value": [pdf.to_json(orient="columns", date_format="iso", date_unit="us")]})

    (df.repartition(num_files).mapInPandas(to_docs, "value string")
       .write.mode("overwrite").text(path))


# ---------------------------------------------------------------- S4: Avro
def read_avro(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None,
              positions: bool = False, split_bytes: int | None = None) -> DataFrame:
    """Avro container files through the data source of ``sources.avro``, several tasks a file. Without ``schema``
    the first file's own is taken; with it, files are resolved against it and other fields are skipped.
    ``split_bytes`` defaults to the session's ``spark.sql.files.maxPartitionBytes``."""
    avro.register(spark)
    if split_bytes is None:
        split_bytes = _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    reader = spark.read.format(avro.FORMAT).option("paths", json.dumps(_as_list(paths))).option("splitBytes", split_bytes)
    if positions:
        schema = schema or reader.load().schema
        schema = T.StructType([*schema.fields, *[T.StructField(n, t) for n, t in avro.POSITION.items()]])
    return (reader if schema is None else reader.schema(schema)).load()


def write_avro(df: DataFrame, path: str, num_files: int, codec: str = "deflate", block_bytes: int = 64 << 10) -> None:
    """Avro container files, one a task; the folder's earlier files go when the new ones are in place."""
    avro.register(df.sparkSession)
    (df.repartition(num_files).write.format(avro.FORMAT).mode("overwrite").option("codec", codec).option("blockBytes", block_bytes)
     .save(path))


def _bytes(size: str) -> int:
    """``134217728b``, ``128MB``, ``128m`` -> bytes."""
    m = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", size.strip().lower())
    if not m:
        raise ValueError(f"not a size: {size!r}")
    return int(m[1]) << 10 * " kmgt".index(m[2] or " ")


# ---------------------------------------------------------------- S6: Parquet
def read_parquet(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None,
                 positions: bool = False) -> DataFrame:
    paths = _as_list(paths)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(*paths)
    return with_read_position(df, paths) if positions else df


# ---------------------------------------------------------------- U1 / U2
def union_all_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames by column name; a column missing in a frame becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def coupons_document(ids: Sequence[int], percents: Sequence[float]) -> str:
    """A column-oriented document as the source system writes it (for hand-made tests)."""
    return json.dumps({"id": {str(i): v for i, v in enumerate(ids)},
                       "discount_percent": {str(i): v for i, v in enumerate(percents)}})
