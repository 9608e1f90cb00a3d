"""Answers from parquet footers (A3): MIN, MAX and COUNT without reading a column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def reader(spark: SparkSession) -> SparkSession:
    """A session of the same application whose parquet scans take aggregates: the V2 reader with
    aggregate pushdown. A session of its own, so that no other query's settings change meanwhile."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def max_of(spark: SparkSession, paths: Sequence[str], column: str) -> DataFrame:
    """(max): the largest value of a column of whole parquet files, from their footers. The files must be unfiltered
    and the column an integer, a float or a date, whose statistics are exact."""
    return reader(spark).read.parquet(*paths).agg(F.max(column).alias("max"))
