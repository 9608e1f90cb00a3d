"""Damaged copies of the model tables, derived from the given ones by rule, so that the constraint checks have
something to find. The same rules stand here as DataFrame expressions and as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.schemas import TableSpec

# Fixed values of the rules: rows whose key leaves this remainder are damaged.
REPEATED = (101, 1)         # the row occurs twice
UNKEYED = (97, 5)           # its key is NULL
ORPHANED = (89, 2)          # its foreign keys name no parent
OVERLONG = (13, 3)          # its texts are padded beyond their VARCHAR
HUGE = (7, 4)               # its numbers leave DECIMAL(10,2)
FAR = 1_000_000_000_000


def number(spec: TableSpec, key: str) -> Column:
    """The key as a number: days since 1970 for a date."""
    return F.unix_date(key).cast("bigint") if isinstance(spec.schema[key].dataType, T.DateType) else F.col(key)


def number_sql(spec: TableSpec, key: str) -> str:
    return f"date_diff('day', DATE '1970-01-01', {key})" if isinstance(spec.schema[key].dataType, T.DateType) else key


def hit(n: Column, rule: tuple[int, int]) -> Column:
    return F.pmod(n, F.lit(rule[0])) == rule[1]


def hit_sql(n: str, rule: tuple[int, int]) -> str:
    return f"(({n}) % {rule[0]} + {rule[0]}) % {rule[0]} = {rule[1]}"


def keys_damaged(df: DataFrame, spec: TableSpec, key: str) -> DataFrame:
    """Repeated and NULL keys."""
    n = number(spec, key)
    rows = df.select(F.when(~hit(n, UNKEYED), F.col(key)).alias(key), n.alias("_n"))
    return rows.select(key).unionAll(rows.where(hit(F.col("_n"), REPEATED)).select(key))


def keys_damaged_sql(source: str, spec: TableSpec, key: str) -> str:
    n = number_sql(spec, key)
    kept = f"CASE WHEN NOT ({hit_sql(n, UNKEYED)}) THEN {key} END AS {key}"
    return f"(SELECT {kept} FROM {source} UNION ALL SELECT {kept} FROM {source} WHERE {hit_sql(n, REPEATED)})"


def orphaned(df: DataFrame, spec: TableSpec, key: str, column: str) -> DataFrame:
    return df.select(F.when(hit(number(spec, key), ORPHANED), F.lit(FAR)).otherwise(F.col(column)).cast("bigint").alias(column))


def orphaned_sql(source: str, spec: TableSpec, key: str, column: str) -> str:
    return f"(SELECT CASE WHEN {hit_sql(number_sql(spec, key), ORPHANED)} THEN {FAR} ELSE {column} END AS {column} FROM {source})"


def nulls(df: DataFrame, spec: TableSpec, key: str) -> DataFrame:
    """The i-th NOT NULL column is NULL where the key leaves 3 modulo 11 + i."""
    n = number(spec, key)
    return df.select(*[F.when(~hit(n, (11 + i, 3)), F.col(c)).alias(c) for i, c in enumerate(spec.not_null)])


def nulls_sql(source: str, spec: TableSpec, key: str) -> str:
    n = number_sql(spec, key)
    return "(SELECT " + ", ".join(f"CASE WHEN NOT ({hit_sql(n, (11 + i, 3))}) THEN {c} END AS {c}" for i, c in enumerate(spec.not_null)) + f" FROM {source})"


def overlong(df: DataFrame, spec: TableSpec, key: str) -> DataFrame:
    n = number(spec, key)
    return df.select(*[F.when(hit(n, OVERLONG), F.rpad(F.coalesce(c, F.lit("")), limit + 1, "x")).otherwise(F.col(c)).alias(c) for c, limit in spec.max_length.items()])


def overlong_sql(source: str, spec: TableSpec, key: str) -> str:
    n = number_sql(spec, key)
    return "(SELECT " + ", ".join(f"CASE WHEN {hit_sql(n, OVERLONG)} THEN rpad(coalesce({c}, ''), {limit + 1}, 'x') ELSE {c} END AS {c}"
                                  for c, limit in spec.max_length.items()) + f" FROM {source})"


def huge(df: DataFrame, key: str, column: str) -> DataFrame:
    return df.select(F.when(hit(F.col(key), HUGE), F.col(column) + 100_000_000).otherwise(F.col(column)).cast("double").alias(column))


def huge_sql(source: str, key: str, column: str) -> str:
    return f"(SELECT CAST(CASE WHEN {hit_sql(key, HUGE)} THEN {column} + 100000000 ELSE {column} END AS DOUBLE) AS {column} FROM {source})"
