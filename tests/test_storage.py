"""Storage and sources: re-runs, stale months, rejected orphans, hard CSV files, encoded paths, exact money."""

import pytest
from pyspark.sql import functions as F

from tillstar.functions.money import discounted, line_total
from tillstar.operators import load
from tillstar.operators.upsert import upsert
from tillstar.sources import files


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture()
def db(spark):
    import uuid
    name = f"storage_{uuid.uuid4().hex[:8]}"
    load.create_layer(spark, name)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_partition_upsert_keeps_untouched_partitions(spark, db):
    make = lambda n, v, f=lambda k: k: spark.range(n).select("id", F.lit(v).alias("v"), (F.col("id") % 300).alias("p"), (F.col("id") % 7).alias("q"))
    load.upsert_partitions(spark, f"{db}.t", make(2100, 1), ["id"], ["v"], ["p", "q"])
    batch = make(2100, 2).where("id % 2 = 0 and p < 290")
    load.upsert_partitions(spark, f"{db}.t", batch, ["id"], ["v"], ["p", "q"])
    got = {r["id"]: r["v"] for r in spark.table(f"{db}.t").collect()}
    assert got == {i: 2 if i % 2 == 0 and i % 300 < 290 else 1 for i in range(2100)}
    load.upsert_partitions(spark, f"{db}.t", batch.limit(0), ["id"], ["v"], ["p", "q"])
    assert spark.table(f"{db}.t").count() == 2100
    with pytest.raises(Exception, match="NULL partition value"):
        load.upsert_partitions(spark, f"{db}.t", batch.withColumn("p", F.lit(None).cast("bigint")), ["id"], ["v"], ["p", "q"])


def test_upsert_guard_without_update_columns(spark):
    target, source = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(2,), (2,)], "k int")
    with pytest.raises(Exception, match="duplicate key"):
        upsert(target, source, ["k"], []).collect()


def test_csv_quotes_line_breaks_and_short_rows(spark, tmp_path):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("address", T.StringType()), T.StructField("zip", T.StringType())])
    good = tmp_path / "a b.csv"
    good.write_text(',id,address,zip\n0,1,"12 ""Oak"", Main",01234\n1,2,"two\nlines",56789\n')
    got = rows(files.read_csv(spark, [str(good)], schema, multiline=True))
    assert got == [(1, '12 "Oak", Main', "01234"), (2, "two\nlines", "56789")]
    short = tmp_path / "short.csv"
    short.write_text(",id,address,zip\n0,1,x\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ"):
        files.read_csv(spark, [str(short)], schema).collect()


def test_read_position_of_encoded_paths(spark, tmp_path):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType())])
    paths = [tmp_path / "z first+100%.csv", tmp_path / "a second.csv"]
    for k, p in enumerate(paths):
        p.write_text(f",id\n0,{k}\n")
    got = {r["id"]: r["_file_ordinal"] for r in files.read_csv(spark, [str(p) for p in paths], schema, positions=True).collect()}
    assert got == {0: 0, 1: 1}


def test_epoch_unit_by_range(spark):
    df = spark.createDataFrame([("1700000000",), ("1700000000000",), ("1700000000000000",), ("2023-11-14 22:13:20",)], "t string")
    from pyspark.sql import types as T
    assert {str(r[0]) for r in df.select(files._timestamp_text(F.col("t"), T.TimestampNTZType())).collect()} == {"2023-11-14 22:13:20"}


def test_money_is_exact_whatever_the_double_looks_like(spark):
    from decimal import Decimal
    rows = [(1000, 0.125, 12.345), (1, 0.1 + 0.2, None), (3, 0.1, 50.0), (100_000, 0.12345, 0.0), (1, 0.00001, 100.0), (7, 128.71428571428572, 10.0),
            (20_000_000, 12_345_678.25, 25.0), (None, 1.0, 1.0), (2, None, 1.0)]
    df = spark.createDataFrame(rows, "a long, p double, d double")
    got = df.select("a", "p", "d", line_total(F.col("a"), F.col("p")).alias("t"), discounted(F.col("a"), F.col("p"), F.col("d")).alias("f")).collect()
    for r in got:
        total = None if r["a"] is None or r["p"] is None else r["a"] * Decimal(repr(r["p"]))
        assert r["t"] == (None if total is None else float(total)), r
        assert r["f"] == (None if total is None else float(total * (100 - Decimal(repr(r["d"] or 0.0))) / 100)), r
