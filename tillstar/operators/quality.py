"""Constraint checks (C1-C6) as distributed set operations.

The warehouse rejects a statement that breaks a key, NULL, length or range rule. Here each
rule is a DataFrame that returns what breaks it, and the ``*_report`` forms return one row per
checked rule with counts (zero when the data is clean), computed in one aggregate pass per
table. Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _any_null(cols: Sequence[str]):
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def check_primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once or contain NULL, with their row count.
    A partial count runs before the shuffle, so a hot key costs one row per map task."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where((F.col("n_rows") > 1) | _any_null(keys)))


def check_foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child key values (not NULL) missing in the parent, with their row count. Child keys
    are counted first (partial aggregation), then anti-joined with the parent keys."""
    keys = (child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")))
    parents = parent.select(F.col(parent_column).alias(column)).where(F.col(column).isNotNull())
    return keys.join(parents, column, "left_anti")


def _pairs(named: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """(c, k): constraint and key, NULL keys left out; a frame that occurs several times is read once."""
    frames: dict[int, tuple[DataFrame, list]] = {}
    for df, name, col in named:
        frames.setdefault(id(df), (df, []))[1].append((name, col))
    parts = []
    for df, keys in frames.values():
        columns = list(dict.fromkeys(col for _, col in keys))
        pairs = F.array(*[F.struct(F.lit(name).alias("c"), F.col(col).cast("bigint").alias("k")) for name, col in keys])
        parts.append(df.select(*columns).select(F.inline(pairs)).where("k is not null"))
    return reduce(DataFrame.unionByName, parts)


def foreign_key_report(checks: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """One row per foreign key: (constraint_name, orphan_keys, orphan_rows).

    One pass over each child: it gives a (constraint, key) pair for each of its foreign keys, counted with partial
    aggregation before the shuffle. Parents give such pairs likewise, and one anti join compares them all. Keys are
    compared as BIGINT."""
    spark = checks[0][1].sparkSession
    children = [(child, name, col) for name, child, col, _, _ in checks]
    parents = [(parent, name, pcol) for name, _, _, parent, pcol in checks]
    orphans = (_pairs(children).groupBy("c", "k").agg(F.count(F.lit(1)).alias("n_rows")).join(_pairs(parents).distinct(), ["c", "k"], "left_anti").groupBy("c")
               .agg(F.count(F.lit(1)).alias("orphan_keys"), F.sum("n_rows").alias("orphan_rows")))
    # one label row per check: bounded by the number of checks
    names = spark.createDataFrame([(c[0],) for c in checks], "c string")
    return (names.join(orphans, "c", "left")
            .select(F.col("c").alias("constraint_name"),
                    F.coalesce(F.col("orphan_keys"), F.lit(0)).cast("bigint").alias("orphan_keys"),
                    F.coalesce(F.col("orphan_rows"), F.lit(0)).cast("bigint").alias("orphan_rows")))


def enforce_foreign_keys(checks: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> None:
    """Fail when any foreign key has orphans, as a declared FOREIGN KEY rejects the statement.
    Runs ``foreign_key_report`` (one row per constraint comes back to the driver)."""
    bad = [r for r in foreign_key_report(checks).collect() if r.orphan_rows]
    if bad:
        detail = ", ".join(f"{r.constraint_name}: {r.orphan_rows} rows / {r.orphan_keys} keys" for r in bad)
        raise ValueError(f"foreign key violation: {detail}")


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of ``cols``."""
    return df.where(_any_null(cols))


def _per_column_counts(df: DataFrame, table: str, conds: dict[str, object], value_name: str) -> DataFrame:
    """One aggregate pass over ``df``: for each column, how many rows meet its condition."""
    aggs = [F.sum(F.when(cond, 1).otherwise(0)).cast("bigint").alias(c) for c, cond in conds.items()]
    wide = df.agg(*aggs)
    names = list(conds)
    return (wide.unpivot([], names, "column_name", value_name)
            .select(F.lit(table).alias("table_name"), "column_name",
                    F.coalesce(F.col(value_name), F.lit(0)).cast("bigint").alias(value_name)))


def not_null_report(tables: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """C3 report: (table_name, column_name, n_null) for every declared NOT NULL column."""
    parts = [_per_column_counts(df, t, {c: F.col(c).isNull() for c in cols}, "n_null")
             for t, df, cols in tables if cols]
    return reduce(DataFrame.unionByName, parts)


def check_length(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """C4: rows with a text longer than its VARCHAR(n)."""
    return df.where(reduce(lambda a, b: a | b, [F.length(c) > n for c, n in limits.items()]))


def length_report(tables: Sequence[tuple[str, DataFrame, dict[str, int]]]) -> DataFrame:
    """C4 report: (table_name, column_name, n_too_long)."""
    parts = [_per_column_counts(df, t, {c: F.length(c) > n for c, n in lim.items()}, "n_too_long")
             for t, df, lim in tables if lim]
    return reduce(DataFrame.unionByName, parts)


def out_of_decimal_range(c: str, precision: int, scale: int):
    return F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({precision},{scale})").isNull()


def check_decimal_range(df: DataFrame, decimals: dict[str, tuple[int, int]]) -> DataFrame:
    """Rows whose value does not fit its DECIMAL(p, s)."""
    return df.where(reduce(lambda a, b: a | b, [out_of_decimal_range(c, p, s) for c, (p, s) in decimals.items()]))


def decimal_range_report(tables: Sequence[tuple[str, DataFrame, dict[str, tuple[int, int]]]]) -> DataFrame:
    """C5 report: (table_name, column_name, n_out_of_range)."""
    parts = [_per_column_counts(df, t, {c: out_of_decimal_range(c, p, s) for c, (p, s) in dec.items()},
                                "n_out_of_range")
             for t, df, dec in tables if dec]
    return reduce(DataFrame.unionByName, parts)


def enforce_primary_keys(tables: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> None:
    """Fail when a primary key is NULL or repeated, as a declared PRIMARY KEY rejects the statement."""
    bad = [r for r in primary_key_report(tables).collect() if r.bad_keys]
    if bad:
        raise ValueError("primary key violation: " + ", ".join(f"{r.table_name}: {r.bad_rows} rows / {r.bad_keys} keys" for r in bad))


def primary_key_report(tables: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """C1 report: (table_name, bad_keys, bad_rows): keys occurring more than once or with NULL."""
    parts = []
    for t, df, keys in tables:
        v = check_primary_key(df.select(*keys), keys)
        parts.append(v.agg(F.count(F.lit(1)).alias("bad_keys"),
                           F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("bad_rows"))
                     .select(F.lit(t).alias("table_name"), "bad_keys", "bad_rows"))
    return reduce(DataFrame.unionByName, parts)
