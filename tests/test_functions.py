import datetime as dt

from pyspark.sql import functions as F

from tillstar.functions.dates import calendar_columns
from tillstar.functions.keys import dense_rank_ids
from tillstar.functions.money import discounted, line_total, money_sum
from tillstar.functions.text import full_name
from tillstar.plans.dims import dim_date


def test_full_name_null_is_empty_text(spark):
    df = spark.createDataFrame([(None, "B"), ("A", None), ("A", "B")], "f string, l string")
    got = [r[0] for r in df.select(full_name("f", "l")).collect()]
    assert got == [" B", "A ", "A B"]


def test_date_parts(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2021, 1, 1),)], "d date")
    rows = {r["date"]: r for r in df.select(*calendar_columns(F.col("d"))).collect()}
    sunday = rows[dt.date(2024, 1, 7)]
    assert (sunday.date_key, sunday.day_of_week, sunday.week) == (20240107, 0, 1)
    jan1 = rows[dt.date(2021, 1, 1)]
    assert (jan1.date_key, jan1.day_of_week, jan1.week, jan1.year, jan1.quarter) == (20210101, 5, 53, 2021, 1)


def test_dim_date_is_by_day(spark):
    orders = spark.createDataFrame([(dt.datetime(2024, 1, 7, 9, 0),), (dt.datetime(2024, 1, 7, 17, 30),),
                                    (None,)], "created_at timestamp_ntz")
    assert dim_date(orders).count() == 1


def test_fixed_total(spark):
    df = spark.createDataFrame([(2, None, 10.0), (3, 19.99, None), (4, 2.5, 100.0), (3, 0.1, 10.0)],
                               "amount bigint, price double, disc double")
    out = df.select(line_total(F.col("amount"), F.col("price")).alias("t"),
                    discounted(F.col("amount"), F.col("price"), F.col("disc")).alias("f")).collect()
    assert out[0].t is None and out[0].f is None          # price NULL -> NULL
    assert out[1].t == out[1].f == 59.97                  # no coupon -> total
    assert out[2].t == 10.0 and out[2].f == 0.0            # 100 % coupon -> 0
    assert out[3].t == 0.3 and out[3].f == 0.27            # exact, not 0.30000000000000004


def test_money_sum_is_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(0.2,)] * 5, "x double")
    assert df.agg(money_sum("x")).first()[0] == 2.0


def test_dense_rank_ids_matches_sorted_order(spark):
    values = [f"v{i % 37:03d}" for i in range(500)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "t string").repartition(7)
    expected = {v: i + 1 for i, v in enumerate(sorted({v for v in values if v is not None}))}
    got = {r.t: r.id for r in dense_rank_ids(df, "t", "id", num_partitions=5).collect()}
    assert got == expected
