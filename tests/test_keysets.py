"""Key sets, keyed appends, declared tables, footers, MERGE command, dbo constraints."""

import uuid

import pytest
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.operators import footers, keysets, load, versions
from tillstar.operators.upsert import merge_sql, merges_rows


@pytest.fixture()
def db(spark, scratch):
    name = f"keys_{uuid.uuid4().hex[:8]}"
    load.create_layer(spark, name, f"{scratch}/{name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def ids(spark, values):
    return spark.createDataFrame([(v, "x") for v in values], "id bigint, v string")


EDGES = [0, 1, -1, 32767, 32768, 32769, -32768, -32769, 10**12, -(10**12), 2**62]


def test_bits_of_every_kind_of_key(spark, db):
    t = f"{db}.t"
    keysets.append_keyed(spark, t, ids(spark, EDGES), "id", "a")
    probe = sorted({v + d for v in EDGES for d in (-1, 0, 1)})
    keys = keysets.sync(spark, t, "id")
    assert sorted(r["key"] for r in keysets.present(spark, keys, ids(spark, probe), "id").collect()) == sorted(EDGES)
    assert sorted(r["key"] for r in keysets.lacking(spark, keys, ids(spark, [*probe, None]), "id").collect()) == sorted(set(probe) - set(EDGES))


def test_keyed_append_rejects_repeated_keys_whole(spark, db):
    t = f"{db}.t"
    assert keysets.append_keyed(spark, t, ids(spark, range(0, 100_000, 2)), "id", "even")
    assert not keysets.append_keyed(spark, t, ids(spark, range(0, 100_000, 2)), "id", "even")          # sent again
    for rows in ([1, 3, 40_000], [5, 7, 5], [9, None]):
        with pytest.raises(ValueError, match="primary key violation"):
            keysets.append_keyed(spark, t, ids(spark, rows), "id", f"bad {rows}")
    assert keysets.append_keyed(spark, t, ids(spark, range(1, 1001, 2)), "id", "odd")
    assert spark.table(t).count() == 50_500 == spark.table(t).select("id").distinct().count()


def test_first_batch_is_checked_too(spark, db):
    with pytest.raises(ValueError, match="repeat"):
        keysets.append_keyed(spark, f"{db}.t", ids(spark, [4, 4]), "id", "a")
    assert not spark.catalog.tableExists(f"{db}.t")
    assert keysets.append_keyed(spark, f"{db}.t", ids(spark, [4]), "id", "b")


def test_key_set_catches_up_after_a_lost_run(spark, db, monkeypatch):
    t = f"{db}.t"
    keysets.append_keyed(spark, t, ids(spark, [1, 2]), "id", "a")
    with monkeypatch.context() as m:
        m.setattr(keysets, "sync", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")) if versions.current(spark, t) == 2 else keysets.name_of(t, "id"))
        with pytest.raises(RuntimeError):
            keysets.append_keyed(spark, t, ids(spark, [3]), "id", "b")                                  # rows are in, the key set is behind
    with pytest.raises(ValueError, match="repeat"):
        keysets.append_keyed(spark, t, ids(spark, [3]), "id", "c")
    assert not keysets.append_keyed(spark, t, ids(spark, [3]), "id", "b")
    assert sorted(r[0] for r in spark.table(t).select("id").collect()) == [1, 2, 3]


def test_key_set_follows_upserts_and_reads_only_touched_ranges(spark, db):
    t, layout = f"{db}.t", versions.Layout(("p",))
    rows = lambda a, b: spark.range(a, b).select("id", F.lit("v").alias("v"), F.floor(F.col("id") / 50_000_000).alias("p"))
    put = lambda df: versions.upsert_versioned(spark, t, df, ["id"], ["v"], layout, remember=("v",))
    put(rows(0, 1000).unionAll(rows(10**8, 10**8 + 1000)))
    keys = keysets.sync(spark, t, "id")
    old = set(versions.read(spark, keys).inputFiles())
    put(rows(10**8 + 500, 10**8 + 1500))
    keysets.sync(spark, t, "id")
    assert len(old & set(versions.read(spark, keys).inputFiles())) == 1                                # the other part keeps its file
    assert keysets.lacking(spark, keys, rows(10**8 + 990, 10**8 + 1510), "id").count() == 10
    versions.replace(spark, t, rows(0, 10), layout)
    assert keysets.lacking(spark, keysets.sync(spark, t, "id"), rows(0, 20), "id").count() == 10       # rebuilt after a replace


def test_declared_tables_reject_what_the_ddl_rejects(spark, db):
    spec = schemas.SPECS["dimensional.dim_customers"]
    load.create_declared(spark, f"{db}.c", spec)
    kinds = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE {db}.c").collect()}
    assert kinds["gender"] == "varchar(1)" and kinds["zip_code"] == "varchar(8)" and kinds["customers_key"] == "bigint"
    row = lambda **kw: spark.createDataFrame([{"customers_key": 1, "full_name": "a b", "first_name": "a", "last_name": "b", "gender": "F", "address": "x", "zip_code": "1"} | kw], spec.schema)
    load.insert_declared(row(), f"{db}.c", spec)
    for bad, why in ((row(gender="MF"), "(?i)length"), (row(zip_code="123456789"), "(?i)length"), (row(customers_key=None), "NOT NULL")):
        with pytest.raises(Exception, match=why):
            load.insert_declared(bad, f"{db}.c", spec)
    assert spark.table(f"{db}.c").count() == 1
    spec = schemas.SPECS["dbo.fact_categories_performance"]
    load.create_declared(spark, f"{db}.f", spec)
    assert {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE {db}.f").collect()}["total_revenue"] == "decimal(10,2)"
    line = lambda v: spark.createDataFrame([(1, "pens", v)], spec.schema)
    load.insert_declared(line(12.345), f"{db}.f", spec)
    with pytest.raises(Exception, match="(?i)overflow|out of range|decimal"):
        load.insert_declared(line(123456789.0), f"{db}.f", spec)
    with pytest.raises(Exception, match="NOT NULL"):
        load.insert_declared(line(None), f"{db}.f", spec)
    assert [float(r["total_revenue"]) for r in spark.table(f"{db}.f").collect()] == [12.35]
    with pytest.raises(Exception, match="beyond DECIMAL"):
        load.conform(line(123456789.0), "dbo.fact_categories_performance").collect()


def test_every_declared_table_can_be_created(spark, db):
    for spec in schemas.STAR + schemas.ERD:
        load.create_declared(spark, f"{db}.{spec.name.replace('.', '_')}", spec)
    assert len(schemas.declared_keys()) == 24


def test_max_from_footers_reads_no_column(spark, scratch):
    spark.range(1000).repartition(3).write.parquet(f"{scratch}/x")
    df = footers.max_of(spark, [f"{scratch}/x"], "id")
    plan = df._jdf.queryExecution().toString()
    assert "PushedAggregation: [MAX(id)]" in plan and "ReadSchema: struct<max(id):bigint>" in plan
    assert df.first()["max"] == 999
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_merge_command(spark, db):
    spark.range(3).select("id", F.lit(1).alias("v"), F.lit(2).alias("w")).write.saveAsTable(f"{db}.m")
    sql = merge_sql(f"{db}.m", f"{db}.m", ["id", "v", "w"], ["id"], ["v"])
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).toString()
    assert plan.startswith("'MergeIntoTable") and "updateaction" in plan.lower() and "insertaction" in plan.lower()
    assert not merges_rows(spark, f"{db}.m") and not merges_rows(spark, f"spark_catalog.{db}.m")


def test_dbo_build_rejects_repeated_keys(spark, scratch):
    from tillstar.plans import warehouse
    tag = uuid.uuid4().hex[:6]
    raw = f"keysraw_{tag}"
    load.create_layer(spark, raw, f"{scratch}/{raw}")
    for name, schema in schemas.RAW.items():
        load.replace(spark.createDataFrame([], schema), f"{raw}.{name}")
    import datetime as dt
    rows = [(1, "1", "O", dt.datetime(2024, 1, 1)), (1, "2", "O", dt.datetime(2024, 1, 2))]
    load.replace(spark.createDataFrame(rows, schemas.RAW["orders"]), f"{raw}.orders")
    with pytest.raises(ValueError, match="dim_orders: 2 rows / 1 keys"):
        warehouse.build_erd(spark, raw, f"keysdbo_{tag}", f"{scratch}/dbo")
    assert not spark.catalog.tableExists(f"keysdbo_{tag}.dim_orders")
