"""A batch into a built warehouse gives the tables of a full rebuild, touches only what it must, and survives failures."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.operators import load, versions
from tillstar.plans import derived, dims, facts, marts, warehouse
from tillstar.plans.warehouse import RAW_LAYOUT, raw_rows

TABLES = [("dim", n) for n in (*dims.BUILDERS, "fact_sales_orders", "fact_product_performance", "fact_product_category_performance")] + [
    ("pres", n) for n in ("daily_order_revenue_per_product", "daily_order_revenue", "daily_order_revenue_per_categories", "daily_order_revenue_per_suppliers",
                          derived.BY_DAY, derived.BY_PRODUCT)]


def day(month, d=1):
    return dt.datetime(2024, month, d, 10, 30)


HISTORY = {
    "coupons": [(1, 10.0), (2, 25.0)],
    "customer": [(i, f"F{i}", f"L{i}", "F", "road", f"0{i}") for i in range(1, 6)],
    "login_attemps": [(i, i, True, day(1, i)) for i in range(1, 6)],
    "product_categories": [(1, "pens"), (2, "inks"), (3, "none")],
    "suppliers": [(1, "S1", "NO"), (2, "S2", "SE")],
    "products": [(1, "pen", 1.5, 1, 1), (2, "nib", 0.25, 1, 2), (3, "ink", 7.125, 2, 2), (4, "gift", None, 2, 1)],
    "orders": [(i, str(i % 5 + 1), "O", day(1 + i % 6, 1 + i)) for i in range(1, 13)],
    "order_items": [(100 * o + k, o, 1 + (o + k) % 5, o + k, (None, 1, 2)[k % 3]) for o in range(1, 13) for k in range(3)],
}
BATCHES = {
    "sales of one month": {"orders": [(50, "2", "O", day(2, 20))], "order_items": [(5000, 50, 1, 3, 1), (5001, 50, 3, 2, None)]},
    "corrected items, and an order that moves to another month": {
        "order_items": [(101, 1, 2, 99, 2), (202, 2, 4, 1, None), (1201, 12, 77, 5, None)], "orders": [(3, "4", "F", day(6, 30))]},
    "prices, names, a supplier, a new product that was sold before": {
        "products": [(1, "PEN", 2.5, 2, 2), (5, "late", 3.0, 1, 1)], "suppliers": [(2, "S2 new", "DK"), (3, "S3", "FI")], "product_categories": [(1, "Pens"), (9, "x")], "coupons": [(1, 50.0), (3, 5.0)], "customer": [(9, "N", "N", "M", "road", "09"), (1, "A", "B", "F", "x", "1")], "login_attemps": [(7, 9, False, day(3)), (8, 5, True, day(3)), (1, 2, False, day(9))]},
    "nothing": {"order_items": []},
}


def frame(spark, name, rows):
    return spark.createDataFrame(rows, schemas.RAW[name])


def start(spark, scratch):
    tag = uuid.uuid4().hex[:8]
    dbs = {k: f"inc_{k}_{tag}" for k in ("raw", "dim", "pres")}
    for db in dbs.values():
        load.create_layer(spark, db, f"{scratch}/{db}")
    for name, rows in HISTORY.items():
        versions.replace(spark, f"{dbs['raw']}.{name}", raw_rows(name, frame(spark, name, rows)), RAW_LAYOUT)
    warehouse.build_star(spark, dbs["raw"], dbs["dim"], dbs["pres"])
    return dbs


def whole(spark, dbs):
    return {n: sorted(map(tuple, (t := spark.table(f"{dbs[layer]}.{n}")).select(*sorted(t.columns)).collect()), key=repr) for layer, n in TABLES}


def merge_raw(spark, dbs, batch):
    for name, rows in batch.items():
        update = [f.name for f in schemas.RAW[name].fields if f.name != "id"]
        versions.upsert_versioned(spark, f"{dbs['raw']}.{name}", raw_rows(name, frame(spark, name, rows)), ["id"], update, RAW_LAYOUT)


def run(spark, dbs, batch):
    warehouse.build_batch(spark, {n: frame(spark, n, rows) for n, rows in batch.items()}, dbs["raw"], dbs["dim"], dbs["pres"])


def files(spark, dbs, name):
    return set(versions.read(spark, f"{dbs['pres']}.{name}").inputFiles())


def expected(spark, dbs):
    """Fact and marts computed plainly from the stored raw tables and dimensions."""
    d = {n: spark.table(f"{dbs['dim']}.{n}").drop("key_range") for n in dims.BUILDERS}
    raw = {n: spark.table(f"{dbs['raw']}.{n}") for n in schemas.RAW}
    fact = facts.fact_sales_orders(raw["order_items"], d["dim_products"], d["dim_orders"], d["dim_customers"], d["dim_coupons"]).cache()
    sums = derived.signed_sums(fact.where("date_key is not null").select(*derived.SALE_COLUMNS, F.lit(1).alias("sign")), "date_key", "product_key")
    return {
        "fact_sales_orders": fact, derived.BY_DAY: sums, "fact_product_performance": facts.product_performance(raw["products"], fact),
        "fact_product_category_performance": facts.category_performance(d["dim_product_categories"], d["dim_products"], fact),
        "daily_order_revenue_per_product": marts.daily_revenue_per_product(fact, d["dim_date"], d["dim_products"], d["dim_suppliers"], d["dim_product_categories"]),
        "daily_order_revenue_per_categories": marts.daily_revenue_per_category(fact, d["dim_date"], d["dim_products"], d["dim_product_categories"]),
        "daily_order_revenue_per_suppliers": marts.daily_revenue_per_supplier(fact, d["dim_date"], d["dim_products"], d["dim_suppliers"]),
    }


def check(spark, dbs, label):
    for name, df in expected(spark, dbs).items():
        stored = spark.table(f"{dbs['pres' if name.startswith(('daily', 'sales')) else 'dim']}.{name}").select(*df.columns)
        assert sorted(map(repr, stored.collect())) == sorted(map(repr, df.collect())), (label, name)


@pytest.fixture(scope="module")
def grown(spark):
    """A warehouse that took all batches one after the other, each checked."""
    from tillstar.session import new_scratch_dir
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    dbs = start(spark, new_scratch_dir(spark, "grown"))
    names = ("daily_order_revenue_per_product", "daily_order_revenue", "daily_order_revenue_per_categories", derived.BY_DAY)
    for label, batch in BATCHES.items():
        before = {n: files(spark, dbs, n) for n in names}
        run(spark, dbs, batch)
        if not label.startswith("corrected"):
            check(spark, dbs, label)
        if label == "sales of one month":       # the other months keep their files
            for n in names:
                now = files(spark, dbs, n)
                assert {month(f) for f in before[n] - now} <= {("2024", "2")} and {month(f) for f in now - before[n]} == {("2024", "2")}
        if label == "nothing":
            assert all(before[n] == files(spark, dbs, n) for n in names)
    yield dbs
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def month(f):
    return f.split("year=")[1][:4], f.split("month=")[1].split("/")[0]


def test_batches_equal_full_rebuilds(spark, scratch, grown):
    dbs = start(spark, scratch)
    for batch in BATCHES.values():
        merge_raw(spark, dbs, batch)
    warehouse.build_star(spark, dbs["raw"], dbs["dim"], dbs["pres"])
    got, want = whole(spark, grown), whole(spark, dbs)
    for t in got:
        assert got[t] == want[t], t


def test_run_lost_at_a_switch_is_caught_up(spark, scratch, monkeypatch):
    """Runs of one batch fail at their second, then their eighth table switch; the next one ends in the right tables."""
    dbs = start(spark, scratch)
    batch = BATCHES["sales of one month"] | {"products": [(1, "PEN", 2.5, 2, 2), (5, "late", 3.0, 1, 1)]}
    real = versions._switch
    for after in (2, 8):
        count = [0]

        def switch(*args, **kw):
            count[0] += 1
            if count[0] == after:
                raise RuntimeError("driver lost")
            return real(*args, **kw)

        with monkeypatch.context() as m:
            m.setattr(versions, "_switch", switch)
            with pytest.raises(RuntimeError, match="driver lost"):
                run(spark, dbs, batch)
    run(spark, dbs, batch)
    check(spark, dbs, "after two lost runs")
    assert spark.table(f"{dbs['raw']}.order_items").where("id = 5000").count() == 1


def test_orphans_are_rejected_before_anything_is_written(spark, grown):
    dbs = grown
    before = whole(spark, dbs)
    with pytest.raises(Exception, match="(?i)foreign key"):
        run(spark, dbs, {"orders": [(60, "777", "O", day(1))], "order_items": [(6000, 60, 1, 1, None)]})
    assert whole(spark, dbs) == before


def test_empty_catalog_finds_the_tables_by_their_files(spark, grown):
    dbs = grown
    want = whole(spark, dbs)
    for db in dbs.values():
        for t in spark.catalog.listTables(db):
            spark.sql(f"DROP {'VIEW' if t.tableType == 'VIEW' else 'TABLE'} {db}.{t.name}")
    warehouse.attach(spark, dbs["raw"], dbs["dim"], dbs["pres"])
    assert whole(spark, dbs) == want
