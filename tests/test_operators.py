import pytest
from pyspark.sql import functions as F

from tillstar.operators import load, quality
from tillstar.operators.upsert import upsert


def _orders(spark, rows):
    return spark.createDataFrame(rows, "order_key bigint, customers_key bigint, status string")


def test_upsert_updates_only_listed_columns(spark):
    target = _orders(spark, [(1, 7, "new"), (2, 5, "old")])
    source = _orders(spark, [(1, 8, "paid"), (3, 9, "new")])
    got = sorted(map(tuple, upsert(target, source, ["order_key"], ["status"]).collect()))
    assert got == [(1, 7, "paid"), (2, 5, "old"), (3, 9, "new")]


def test_upsert_twice_equals_once(spark):
    target = _orders(spark, [(1, 7, "new"), (2, 5, "old")])
    source = _orders(spark, [(1, 8, "paid"), (3, 9, "new")])
    once = upsert(target, source, ["order_key"], ["status"])
    twice = upsert(once, source, ["order_key"], ["status"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


@pytest.mark.parametrize("rows", [[(1, 8, "a"), (1, 9, "b")], [(None, 8, "a")]])
def test_upsert_rejects_bad_source(spark, rows):
    target = _orders(spark, [(1, 7, "new")])
    with pytest.raises(Exception):
        upsert(target, _orders(spark, rows), ["order_key"], ["status"]).collect()


def test_primary_key_check(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id bigint")
    got = sorted(map(tuple, quality.check_primary_key(df, ["id"]).collect()), key=str)
    assert got == [(1, 2), (None, 1)]


def test_foreign_key_check_null_passes(spark):
    child = spark.createDataFrame([(1,), (2,), (None,), (2,)], "product_id bigint")
    parent = spark.createDataFrame([(1,)], "id bigint")
    got = list(map(tuple, quality.check_foreign_key(child, "product_id", parent, "id").collect()))
    assert got == [(2, 2)]


def test_length_and_decimal_checks(spark):
    df = spark.createDataFrame([("MF", 123456789.0), ("F", 12.5)], "gender string, qty double")
    assert quality.check_length(df, {"gender": 1}).count() == 1
    assert quality.check_decimal_range(df, {"qty": (10, 2)}).count() == 1
    rep = quality.decimal_range_report([("t", df, {"qty": (10, 2)})]).collect()
    assert [(r.table_name, r.column_name, r.n_out_of_range) for r in rep] == [("t", "qty", 1)]


def test_not_null_report(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a bigint, b string")
    rep = {r.column_name: r.n_null for r in quality.not_null_report([("t", df, ["a", "b"])]).collect()}
    assert rep == {"a": 1, "b": 2}


def test_load_modes_and_upsert_table(spark, scratch):
    load.create_layer(spark, "t_load", scratch)
    a = _orders(spark, [(1, 7, "new"), (2, 5, "old")])
    load.replace(a, "t_load.orders")
    load.replace(a.where("order_key = 1"), "t_load.orders")
    assert spark.table("t_load.orders").count() == 1
    load.append(a, "t_load.orders")
    assert spark.table("t_load.orders").count() == 3
    load.replace(a, "t_load.dim_orders")
    src = _orders(spark, [(1, 8, "paid"), (3, 9, "new")])
    load.upsert_table(spark, "t_load.dim_orders", src, ["order_key"], ["status"])
    load.upsert_table(spark, "t_load.dim_orders", src, ["order_key"], ["status"])   # re-run: same result
    got = sorted(map(tuple, spark.table("t_load.dim_orders").collect()))
    assert got == [(1, 7, "paid"), (2, 5, "old"), (3, 9, "new")]
    assert not [t for t in spark.catalog.listTables("t_load") if "staging" in t.name]


def test_overwrite_partitions_is_rerun_safe(spark, scratch):
    load.create_layer(spark, "t_parts", scratch)
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "day string, v int")
    load.overwrite_partitions(df, "t_parts.m", ["day"])
    load.overwrite_partitions(df.where("day = '2024-01-02'").withColumn("v", F.lit(5)), "t_parts.m", ["day"])
    load.overwrite_partitions(df.where("day = '2024-01-02'").withColumn("v", F.lit(5)), "t_parts.m", ["day"])
    got = sorted((r.day, r.v) for r in spark.table("t_parts.m").collect())
    assert got == [("2024-01-01", 1), ("2024-01-02", 5)]


def test_upsert_partitions_touches_only_source_partitions(spark, scratch):
    load.create_layer(spark, "t_up", scratch)
    rows = [(k, k // 10, 7, "new") for k in range(40)]
    df = spark.createDataFrame(rows, "order_key bigint, key_range bigint, customers_key bigint, status string")
    load.upsert_partitions(spark, "t_up.o", df, ["order_key"], ["status"], ["key_range"])
    src = spark.createDataFrame([(5, 0, 8, "paid"), (41, 4, 9, "new")],
                                "order_key bigint, key_range bigint, customers_key bigint, status string")
    load.upsert_partitions(spark, "t_up.o", src, ["order_key"], ["status"], ["key_range"])
    load.upsert_partitions(spark, "t_up.o", src, ["order_key"], ["status"], ["key_range"])
    got = {r.order_key: (r.customers_key, r.status) for r in spark.table("t_up.o").collect()}
    assert len(got) == 41 and spark.table("t_up.o").count() == 41
    assert got[5] == (7, "paid") and got[41] == (9, "new") and got[15] == (7, "new")


def test_conform_enforces_declared_constraints(spark):
    ok = spark.createDataFrame([(1, "A B", "A", "B", "F", "x", "00123")],
                               "customers_key bigint, full_name string, first_name string, last_name string, "
                               "gender string, address string, zip_code string")
    assert load.conform(ok, "dimensional.dim_customers").count() == 1
    too_long = ok.withColumn("gender", F.lit("MF"))
    with pytest.raises(Exception, match="VARCHAR"):
        load.conform(too_long, "dimensional.dim_customers").collect()
    assert load.conform(too_long, "dimensional.dim_customers", enforce=False).count() == 1
    null_key = ok.withColumn("customers_key", F.lit(None).cast("bigint"))
    with pytest.raises(Exception, match="NOT NULL"):
        load.conform(null_key, "dimensional.dim_customers").collect()


def test_upsert_table_recovers_interrupted_swap(spark, scratch, monkeypatch):
    load.create_layer(spark, "t_rec", scratch)
    load.replace(_orders(spark, [(1, 7, "new"), (2, 5, "old")]), "t_rec.o")
    src = _orders(spark, [(1, 8, "paid")])

    def die_after_drop(spark_, staging, table):
        spark_.sql(f"DROP TABLE {table}")
        raise RuntimeError("driver lost")
    monkeypatch.setattr(load, "swap_in", die_after_drop)
    with pytest.raises(RuntimeError):
        load.upsert_table(spark, "t_rec.o", src, ["order_key"], ["status"])
    monkeypatch.undo()
    assert not spark.catalog.tableExists("t_rec.o")
    # the re-run finishes the swap first, then applies its batch
    load.upsert_table(spark, "t_rec.o", _orders(spark, [(3, 9, "new")]), ["order_key"], ["status"])
    got = sorted(map(tuple, spark.table("t_rec.o").collect()))
    assert got == [(1, 7, "paid"), (2, 5, "old"), (3, 9, "new")]
    assert not [t for t in spark.catalog.listTables("t_rec") if "staging" in t.name]


def test_enforce_foreign_keys(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id bigint")
    ok = spark.createDataFrame([(1,), (None,)], "pid bigint")
    quality.enforce_foreign_keys([("ok.pid", ok, "pid", parent, "id")])
    orphan = spark.createDataFrame([(1,), (3,), (3,)], "pid bigint")
    with pytest.raises(ValueError, match="orphan.pid: 2 rows / 1 keys"):
        quality.enforce_foreign_keys([("ok.pid", ok, "pid", parent, "id"), ("orphan.pid", orphan, "pid", parent, "id")])
