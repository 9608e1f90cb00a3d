"""Versioned tables: all or nothing, untouched files kept, no shuffle of a bucketed target, exactly-once appends, changes."""

import uuid

import pytest
from pyspark.sql import functions as F

from tillstar.operators import load, versions
from tillstar.operators.versions import Layout

BY_RANGE = Layout(("p",), ("id",), 4)


def rows(df):
    return sorted(map(tuple, df.select("id", "x").collect()))


def make(spark, a, b, x):
    return spark.range(a, b).select("id", F.lit(x).cast("long").alias("x"), F.floor(F.col("id") / 100).alias("p"))


@pytest.fixture()
def db(spark, scratch):
    name = f"versions_{uuid.uuid4().hex[:8]}"
    load.create_layer(spark, name, f"{scratch}/{name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.mark.parametrize("layout", [BY_RANGE, Layout(("p",)), Layout()])
def test_upsert_writes_touched_partitions_only(spark, db, layout):
    t = f"{db}.t"
    assert versions.upsert_versioned(spark, t, make(spark, 0, 1000, 1), ["id"], ["x"], layout) == 1
    before = {f for f in versions.read(spark, t).inputFiles()}
    assert versions.upsert_versioned(spark, t, make(spark, 450, 620, 2), ["id"], ["x"], layout) == 2
    assert rows(spark.table(t)) == [(i, 2 if 450 <= i < 620 else 1) for i in range(1000)]
    kept = before & set(versions.read(spark, t).inputFiles())
    if layout.partition_by:
        assert {int(f.split("/p=")[1].split("/")[0]) for f in kept} == {0, 1, 2, 3, 7, 8, 9}
    assert rows(versions.read(spark, t, 1)) == [(i, 1) for i in range(1000)]            # the old version is whole
    versions.upsert_versioned(spark, t, make(spark, 990, 1200, 3), ["id"], ["x"], layout)
    assert rows(spark.table(t)) == [(i, 3 if i >= 990 else 2 if 450 <= i < 620 else 1) for i in range(1200)]
    assert versions.upsert_versioned(spark, t, make(spark, 0, 0, 3), ["id"], ["x"], layout) in (3, 4)
    assert spark.table(t).count() == 1200


@pytest.mark.parametrize("step", ["_write", "write_small_file", "_define", "_switch"])
def test_job_lost_at_any_step_leaves_the_old_table(spark, db, monkeypatch, step):
    t = f"{db}.t"
    versions.upsert_versioned(spark, t, make(spark, 0, 300, 1), ["id"], ["x"], BY_RANGE)

    def lost(*a, **k):
        raise RuntimeError("executor and driver lost")

    batch = make(spark, 50, 350, 2)
    with monkeypatch.context() as m:
        m.setattr(versions, step, lost)
        with pytest.raises(RuntimeError, match="lost"):
            versions.upsert_versioned(spark, t, batch, ["id"], ["x"], BY_RANGE)
    assert rows(spark.table(t)) == [(i, 1) for i in range(300)]
    versions.upsert_versioned(spark, t, batch, ["id"], ["x"], BY_RANGE)
    assert rows(spark.table(t)) == [(i, 2 if i >= 50 else 1) for i in range(350)]
    versions.vacuum(spark, t, keep=1, older_than_seconds=0)
    assert rows(spark.table(t)) == [(i, 2 if i >= 50 else 1) for i in range(350)]


def test_failing_rows_leave_the_old_table(spark, db):
    t = f"{db}.t"
    versions.upsert_versioned(spark, t, make(spark, 0, 300, 1), ["id"], ["x"], BY_RANGE)
    twice = make(spark, 0, 5, 2).unionAll(make(spark, 4, 6, 3))
    with pytest.raises(Exception, match="duplicate key"):
        versions.upsert_versioned(spark, t, twice, ["id"], ["x"], BY_RANGE)
    with pytest.raises(Exception, match="NULL partition value"):
        versions.upsert_versioned(spark, t, make(spark, 0, 5, 2).withColumn("p", F.lit(None).cast("bigint")), ["id"], ["x"], BY_RANGE)
    assert rows(spark.table(t)) == [(i, 1) for i in range(300)]


def test_merge_does_not_shuffle_a_bucketed_target(spark, db):
    from tillstar.operators.upsert import upsert
    t = f"{db}.t"
    versions.upsert_versioned(spark, t, make(spark, 0, 1000, 1), ["id"], ["x"], BY_RANGE)
    merged = upsert(versions.read(spark, t).where("p in (4, 5)"), make(spark, 450, 620, 2), ["id"], ["x"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan") - 400: plan.index("FileScan")]
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1 and "Exchange" not in scan.split("SortMergeJoin")[-1]
    assert "PartitionFilters: [p" in plan


def test_partition_values_that_need_escaping(spark, db):
    t, layout = f"{db}.t", Layout(("q", "p"))
    df = spark.createDataFrame([(1, 1, "a b", "x/y=z"), (2, 1, "it's", "50%"), (3, 1, "\\n:", "ünd")], "id long, x long, q string, p string")
    versions.upsert_versioned(spark, t, df, ["id"], ["x"], layout)
    versions.upsert_versioned(spark, t, df.where("id != 2").withColumn("x", F.lit(7).cast("long")), ["id"], ["x"], layout)
    assert sorted(map(tuple, spark.table(t).select("id", "x", "q", "p").collect())) == [(1, 7, "a b", "x/y=z"), (2, 1, "it's", "50%"), (3, 7, "\\n:", "ünd")]


def test_append_once(spark, db, monkeypatch):
    t = f"{db}.t"
    assert versions.append_once(spark, t, make(spark, 0, 5, 1), "monday")
    assert versions.append_once(spark, t, make(spark, 0, 5, 1), "tuesday's")
    assert not versions.append_once(spark, t, make(spark, 0, 5, 1), "monday")
    for step in ("_write", "_define", "_switch"):
        with monkeypatch.context() as m:
            m.setattr(versions, step, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                versions.append_once(spark, t, make(spark, 0, 2, 9), "wednesday")
        assert spark.table(t).count() == 10
    assert versions.append_once(spark, t, make(spark, 0, 2, 9), "wednesday")
    assert not versions.append_once(spark, t, make(spark, 0, 2, 9), "wednesday")
    assert spark.table(t).count() == 12
    assert versions.append_once(spark, t, make(spark, 0, 0, 9), "nothing") and not versions.append_once(spark, t, make(spark, 0, 3, 9), "nothing")
    assert spark.table(t).count() == 12


def test_changes_tell_old_and_new_rows(spark, db):
    t = f"{db}.t"
    put = lambda df: versions.upsert_versioned(spark, t, df, ["id"], ["x"], BY_RANGE, remember=("x",))
    put(make(spark, 0, 200, 1))
    put(make(spark, 150, 250, 2))
    put(make(spark, 240, 241, 3))
    told = lambda after: sorted(map(tuple, versions.changes(spark, t, after, ("id", "x"), ("x",)).collect()))
    assert told(3) == [] and told(2) == [(240, 2, -1), (240, 3, 1)]
    assert told(1) == sorted([(i, 1, -1) for i in range(150, 200)] + [(i, 2, 1) for i in range(150, 250)] + told(2))
    assert told(0) == sorted([(i, 1, 1) for i in range(200)] + told(1))
    assert versions.fresh(spark, t, 1) == ({"p=1", "p=2"}, True) and versions.fresh(spark, t, 2) == ({"p=2"}, True)
    assert sorted(r[0] for r in versions.changed_keys(spark, t, 1, ["id"], ["x"]).collect()) == list(range(150, 250))
    put(make(spark, 0, 250, 9).where("id < 3").unionAll(make(spark, 10, 12, 1)))
    assert sorted(r[0] for r in versions.changed_keys(spark, t, 3, ["id"], ["x"]).collect()) == [0, 1, 2]
    versions.replace(spark, t, make(spark, 0, 5, 1), BY_RANGE)
    assert versions.fresh(spark, t, 4) == ({"p=0", "p=1", "p=2"}, False)


def test_changes_leave_out_a_version_that_was_lost(spark, db, monkeypatch):
    t = f"{db}.t"
    put = lambda df: versions.upsert_versioned(spark, t, df, ["id"], ["x"], BY_RANGE, remember=("x",))
    put(make(spark, 0, 10, 1))
    with monkeypatch.context() as m:
        m.setattr(versions, "_switch", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            put(make(spark, 0, 1, 5))
    assert put(make(spark, 0, 1, 5)) == 3
    assert sorted(map(tuple, versions.changes(spark, t, 1, ("id", "x"), ("x",)).collect())) == [(0, 1, -1), (0, 5, 1)]


def test_removed_partitions_are_told_and_gone(spark, db):
    t, layout = f"{db}.t", Layout(("p",))
    versions.replace(spark, t, make(spark, 0, 300, 1), layout)
    versions.replace_partitions(spark, t, make(spark, 100, 150, 2), spark.createDataFrame([(1,), (2,)], "p long"), layout)
    assert rows(spark.table(t)) == [(i, 1) for i in range(100)] + [(i, 2) for i in range(100, 150)]
    assert versions.fresh(spark, t, 1)[0] == {"p=1", "p=2"}


def test_attach_and_vacuum(spark, db):
    t = f"{db}.t"
    for x in (1, 2, 3, 4):
        versions.upsert_versioned(spark, t, make(spark, 0, 150 + x, x), ["id"], ["x"], BY_RANGE)
    assert versions.vacuum(spark, t, keep=2, older_than_seconds=3600) == []
    assert versions.vacuum(spark, t, keep=2, older_than_seconds=0) == [1, 2]
    want = [(i, 4) for i in range(154)]
    assert rows(spark.table(t)) == want and versions.stored_versions(spark, t) == [3, 4]
    spark.sql(f"DROP VIEW {t}")
    spark.sql(f"DROP TABLE {versions.version_table(t, 4)}")
    assert versions.attach(spark, t, BY_RANGE) == 4 and rows(spark.table(t)) == want
    assert versions.upsert_versioned(spark, t, make(spark, 0, 1, 5), ["id"], ["x"], BY_RANGE) == 5


def test_plain_table_of_the_same_name_is_refused(spark, db):
    load.replace(make(spark, 0, 3, 1), f"{db}.plain")
    with pytest.raises(ValueError, match="not kept in versions"):
        versions.upsert_versioned(spark, f"{db}.plain", make(spark, 0, 3, 1), ["id"], ["x"], BY_RANGE)


@pytest.fixture()
def orders_dir(spark, scratch):
    """Orders 0 to 8191: those of an odd key range of 256 keys on an old day, the others on days around the batch's, some on none."""
    from datetime import datetime
    days = [datetime(1996, 5, 1), datetime(1998, 5, 1), datetime(2000, 5, 1), None]
    rows = [(k, k % 7, "O", days[k % 4] if k // 256 % 2 == 0 else days[0]) for k in range(8192)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp").write.parquet(f"{scratch}/orders.parquet")
    return scratch


def test_incremental_upsert_takes_the_whole_batch(spark, orders_dir):
    from tillstar import queries
    got = {r.order_key: (r.customers_key, r.status, str(r.created_at), r.touched) for r in queries.upsert_partitions_incremental(spark, orders_dir).collect()}
    want = {}
    for k in range(8192):
        even = k // 256 % 2 == 0
        case = k % 4 if even else 0
        day = ["1996-05-01", "1998-05-01", "2000-05-01", "None"][case]
        want[k] = (k % 7 + (case == 2), "F" if case in (1, 2) else "O", day, even)
    assert got == want


def test_incremental_upsert_stores_few_partitions(spark, orders_dir, monkeypatch):
    from tillstar import queries
    written, write = [], versions._write

    def spy(*args):
        folder, specs = write(*args)
        written.append((len(specs), spark.read.parquet(folder).select(F.input_file_name()).distinct().count()))
        return folder, specs

    monkeypatch.setattr(versions, "_write", spy)
    assert queries.upsert_partitions_incremental(spark, orders_dir).where("touched").count() == 4096
    # one partition of the warehouse's width, at most a file a bucket and task: neither grows with the ranges of 256 keys
    assert len(written) == 2 and all(parts == 1 and files <= 64 for parts, files in written), written


@pytest.mark.parametrize("name,mart,rows_out", [
    ("load_append", "daily_revenue_per_category", 2000), ("load_overwrite_partitions", "daily_revenue_per_category", 1000),
    ("load_append_once", "daily_revenue_per_supplier", 1000)])
def test_a_mart_loaded_twice_is_computed_once(spark, monkeypatch, name, mart, rows_out):
    from tillstar import queries
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def revenue(i):
        made.add(1)
        return float(i)

    days = spark.range(1000).select(F.expr("date_add(date'1994-01-01', cast(id as int))").alias("date"), F.lit("c").alias("category"),
                                    F.col("id").alias("amount"), revenue.asNondeterministic()("id").alias("revenue"))
    monkeypatch.setattr(queries, mart, lambda *_: days)
    assert getattr(queries, name)(spark, "").count() == rows_out
    assert made.value == 1000
