"""The ingest + model job end to end, on files written from the smallest test tables."""
import pytest

from tillstar.plans import warehouse
from tillstar.queries import QUERIES
from tillstar.sources.testdata import SourceTables, write_source_files

from conftest import SF_SMALL


def _rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def built(spark):
    from tillstar.session import new_scratch_dir
    root = new_scratch_dir(spark, "warehouse")
    specs = write_source_files(spark, SF_SMALL, root)
    warehouse.ingest(spark, specs, "wh_raw", f"{root}/raw")
    locs = {"wh_dim": f"{root}/dim", "wh_pres": f"{root}/pres"}
    warehouse.build_star(spark, "wh_raw", "wh_dim", "wh_pres", locs)
    warehouse.build_erd(spark, "wh_raw", "wh_dbo", f"{root}/dbo")
    return specs, locs


def test_ingest_keeps_last_version(spark, built):
    assert _rows(spark.table("wh_raw.order_items")) == _rows(SourceTables(spark, SF_SMALL).order_items)


def test_star_tables_match_queries(spark, built):
    for table, query in (("wh_dim.dim_orders", "dim_orders"), ("wh_dim.dim_customers", "dim_customers"),
                         ("wh_dim.fact_sales_orders", "fact_sales_orders"),
                         ("wh_dim.fact_product_performance", "product_performance"),
                         ("wh_dim.fact_product_category_performance", "category_performance")):
        got = spark.table(table).drop("key_range")
        assert _rows(got) == _rows(QUERIES[query](spark, SF_SMALL)), table
    assert "key_range" in spark.table("wh_dim.dim_orders").columns       # stored in key-range partitions
    for table, query in (("wh_pres.daily_order_revenue", "daily_revenue"),
                         ("wh_pres.daily_order_revenue_per_product", "daily_revenue_per_product"),
                         ("wh_pres.daily_order_revenue_per_categories", "daily_revenue_per_category"),
                         ("wh_pres.daily_order_revenue_per_suppliers", "daily_revenue_per_supplier")):
        got = spark.table(table).drop("year", "month")
        assert _rows(got) == _rows(QUERIES[query](spark, SF_SMALL)), table


def test_erd_tables(spark, built):
    assert _rows(spark.table("wh_dbo.fact_sale_orders")) == _rows(QUERIES["sale_lines_erd"](spark, SF_SMALL))
    assert _rows(spark.table("wh_dbo.fact_categories_performance")) == _rows(
        QUERIES["category_revenue_erd"](spark, SF_SMALL))


def test_rerun_is_idempotent(spark, built):
    specs, locs = built
    before = {t: _rows(spark.table(t)) for t in ("wh_dim.fact_sales_orders", "wh_pres.daily_order_revenue",
                                                 "wh_pres.daily_order_revenue_per_product", "wh_dim.dim_orders")}
    warehouse.ingest(spark, specs, "wh_raw")
    warehouse.build_star(spark, "wh_raw", "wh_dim", "wh_pres", locs)
    for t, rows in before.items():
        assert _rows(spark.table(t)) == rows, t


def test_quality_reports(spark, built, scratch):
    warehouse.quality_reports(spark, "wh_dim", "wh_pres", "wh_quality", scratch + "/quality")
    pk = spark.table("wh_quality.primary_keys").collect()
    assert len(pk) == 12 and all(r.bad_keys == 0 for r in pk)
    fk = spark.table("wh_quality.foreign_keys").collect()
    assert len(fk) == 11 and all(r.orphan_rows == 0 for r in fk)      # the 11 declared FOREIGN KEYs
    assert all(r.n_null == 0 for r in spark.table("wh_quality.not_null").collect())
    assert all(r.n_too_long == 0 for r in spark.table("wh_quality.lengths").collect())
