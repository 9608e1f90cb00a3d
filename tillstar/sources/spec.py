"""Source descriptions of the ingest job: which reader, which files, in which order."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tillstar.schemas import RAW
from tillstar.sources import files

FORMATS = ("csv", "json_columns", "json_records", "avro", "parquet")


@dataclass(frozen=True)
class SourceSpec:
    name: str                       # raw table name (a key of schemas.RAW)
    format: str                     # one of FORMATS
    paths: tuple[str, ...]          # in concatenation order; "last" follows this order
    options: dict = field(default_factory=dict)


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """The source's rows with their read position (for keep-last)."""
    schema = RAW[spec.name]
    paths = list(spec.paths)
    if spec.format == "csv":
        return files.read_csv(spark, paths, schema, index_column=spec.options.get("index_column", True),
                              positions=True)
    if spec.format == "json_columns":
        return files.read_json_columns(spark, paths, schema, positions=True,
                                       multiline=spec.options.get("multiline", False))
    if spec.format == "json_records":
        return files.read_json_records(spark, paths, schema, positions=True,
                                       multiline=spec.options.get("multiline", False))
    if spec.format == "avro":
        return files.read_avro(spark, paths, schema, positions=True)
    if spec.format == "parquet":
        return files.read_parquet(spark, paths, schema, positions=True)
    raise ValueError(f"unknown format {spec.format!r}; expected one of {FORMATS}")
