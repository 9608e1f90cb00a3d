import datetime as dt

from pyspark.sql import functions as F

from tillstar.plans import dims, facts, marts
from tillstar.queries import QUERIES, Model

from conftest import SF_SMALL


def _sum(df, c):
    return df.agg(F.sum(F.col(c).cast("decimal(38,6)"))).first()[0]


def test_entry_runs(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["date", "amount", "revenue"]
    assert df.count() > 0


def test_every_query_has_oracle():
    from tillstar.oracle import oracle_sql
    assert set(QUERIES) == set(oracle_sql())


def test_revenue_invariants(spark):
    total = _sum(QUERIES["daily_revenue"](spark, SF_SMALL), "revenue")
    for name in ("daily_revenue_per_product", "daily_revenue_per_category", "daily_revenue_per_supplier"):
        assert _sum(QUERIES[name](spark, SF_SMALL), "revenue") == total, name
    m = Model(spark, SF_SMALL)
    assert m.fact.count() == m.raw["order_items"].count()
    assert _sum(m.fact, "fixed_total") == total


def test_as_written_product_performance_is_grand_total(spark):
    df = QUERIES["product_performance_as_written"](spark, SF_SMALL)
    fact = Model(spark, SF_SMALL).fact
    grand = fact.where("product_key is not null").agg(F.sum("amount")).first()[0]
    assert {r[0] for r in df.select("count_of_sales").distinct().collect()} == {float(grand)}


def test_login_filter_is_strict(spark):
    logins = spark.createDataFrame([(1, 1, True, dt.datetime(2024, 1, 1, 8)), (2, 3, True, dt.datetime(2024, 1, 2)),
                                    (3, None, False, dt.datetime(2024, 1, 3)), (4, 2, True, dt.datetime(2024, 1, 4))],
                                   "id bigint, customer_id bigint, login_successful boolean, attempted_at timestamp_ntz")
    customers = spark.createDataFrame([(1,), (3,)], "id bigint")
    assert sorted(r.login_key for r in dims.dim_login_attempts(logins, customers).collect()) == [1, 4]
    assert sorted(r.login_key for r in dims.dim_login_attempts_known(logins, customers).collect()) == [1, 2]


def test_category_without_sales_first(spark):
    cats = spark.createDataFrame([(1, "a"), (2, "b"), (3, "empty")], "product_categories_key bigint, name string")
    prods = spark.createDataFrame([(10, "p", 2.0, 1, 1), (11, "q", 3.0, 2, 1)],
                                  "products_key bigint, name string, price double, product_categories_key bigint, "
                                  "suppliers_key bigint")
    fact = spark.createDataFrame([(10, 1, 2.0), (11, 5, 15.0)], "product_key bigint, amount bigint, fixed_total double")
    rows = facts.category_performance(cats, prods, fact).collect()
    assert [r.category_key for r in rows] == [3, 2, 1]
    assert rows[0].total_revenue is None and rows[1].total_revenue == 15.0


def test_fact_keeps_every_item(spark):
    items = spark.createDataFrame([(1, 100, 10, 2, None), (2, 101, 99, 1, 5)],
                                  "id bigint, order_id bigint, product_id bigint, amount bigint, coupon_id bigint")
    prods = spark.createDataFrame([(10, "p", 2.5, 1, 1)], "products_key bigint, name string, price double, "
                                  "product_categories_key bigint, suppliers_key bigint")
    orders = spark.createDataFrame([(100, 7, "O", dt.date(2024, 1, 7))],
                                   "order_key bigint, customers_key bigint, status string, created_at date")
    cust = spark.createDataFrame([(8,)], "customers_key bigint")
    coup = spark.createDataFrame([(5, 50.0)], "coupon_key bigint, discount_percent double")
    rows = {r.sale_order_key: r for r in facts.fact_sales_orders(items, prods, orders, cust, coup).collect()}
    assert rows[1].date_key == 20240107 and rows[1].customers_key is None and rows[1].fixed_total == 5.0
    assert rows[2].product_key is None and rows[2].total is None and rows[2].discount == 50.0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    m = Model(spark, SF_SMALL)
    p = _plan(m.raw["order_items"])
    assert "WindowGroupLimit" in p            # keep-last: top-1 per key before the shuffle
    for name in ("daily_revenue", "daily_revenue_per_product", "daily_revenue_per_category",
                 "daily_revenue_per_supplier", "product_performance", "product_performance_as_written",
                 "category_performance", "fact_sales_orders", "sale_lines_erd"):
        plan = _plan(QUERIES[name](spark, SF_SMALL))
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan, name
    logins = _plan(QUERIES["dim_login_attempts"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(user_id), LessThan(user_id,ScalarSubquery" in logins
