"""Facts of the star model (M1-M3).

M1 joins order items to four dimensions. Products, orders and customers grow with the data,
so those joins are left to the planner (sort-merge with AQE skew splitting, or broadcast when
the measured size is small); so are the small ones (coupons, categories).

M2 and M3 aggregate the fact by product first (partial aggregation before the shuffle) and
join the much smaller per-product result to the dimensions, instead of joining every fact row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions.dates import date_key
from tillstar.functions.money import discounted, line_total, money_sum_dec, repeated


def fact_sales_orders(order_items: DataFrame, dim_products: DataFrame, dim_orders: DataFrame,
                      dim_customers: DataFrame | None, dim_coupons: DataFrame) -> DataFrame:
    """M1: one row per order item; every item is kept (left joins). Without ``dim_customers`` that join is left out
    (customers_key is NULL): the marts and performance facts do not need it.

    The customer join only asks whether the order's customer exists, and its condition uses
    order columns only, so it is applied to orders before they meet the items:
    ``(items ⟕ orders) ⟕ customers = items ⟕ (orders ⟕ customers)``. That join then runs over
    orders, not over the (larger) items.
    """
    if dim_customers is None:
        orders = dim_orders.select("order_key", F.lit(None).cast("bigint").alias("customers_key"), "status", "created_at")
    else:
        cust = dim_customers.select(F.col("customers_key").alias("_ck"))
        orders = (dim_orders.join(cust, dim_orders["customers_key"] == cust["_ck"], "left")
                  .select(F.col("order_key"), F.col("_ck").alias("customers_key"), "status", "created_at"))
    prod = dim_products.select(F.col("products_key"), F.col("price"))
    coup = dim_coupons.select("coupon_key", "discount_percent")

    oi = order_items.select(F.col("id").alias("sale_order_key"), "order_id", "product_id", "amount", "coupon_id")
    j = (oi.join(prod, oi["product_id"] == prod["products_key"], "left")
           .join(orders, F.col("order_id") == orders["order_key"], "left")
           .join(coup, F.col("coupon_id") == coup["coupon_key"], "left"))
    return j.select(
        F.col("sale_order_key").cast("bigint").alias("sale_order_key"),
        F.col("order_key"),
        F.col("customers_key"),
        F.col("products_key").alias("product_key"),
        F.col("coupon_key"),
        date_key(F.col("created_at")).alias("date_key"),
        F.col("amount").cast("bigint").alias("amount"),
        F.col("price").alias("price_per_unit"),
        line_total(F.col("amount"), F.col("price")).alias("total"),
        F.col("discount_percent").alias("discount"),
        discounted(F.col("amount"), F.col("price"), F.col("discount_percent")).alias("fixed_total"),
        F.col("status"),
        F.col("created_at"),
    )


def sales_by_product(fact: DataFrame) -> DataFrame:
    """(product_key, amount, revenue_dec) over facts with a product; exact revenue sum."""
    return (fact.where(F.col("product_key").isNotNull())
            .groupBy("product_key")
            .agg(F.sum("amount").alias("amount"), money_sum_dec("fixed_total").alias("revenue_dec")))


def _products_by_id(products: DataFrame) -> DataFrame:
    """Raw products grouped by id: name = MAX(name), and how many raw rows share the id (each
    of them meets the same fact rows in the SQL join, so sums scale by that count)."""
    return products.groupBy("id").agg(F.max("name").alias("name"), F.count(F.lit(1)).alias("_rows"))


def product_performance(products: DataFrame, fact: DataFrame) -> DataFrame:
    """M2, keyed: ``products ⟕ fact ON fact.product_key = products.id GROUP BY products.id``."""
    return performance_of(products, sales_by_product(fact))


def performance_of(products: DataFrame, sales: DataFrame) -> DataFrame:
    """M2 from sums (product_key, amount, revenue_dec)."""
    p = _products_by_id(products)
    j = p.join(sales, p["id"] == sales["product_key"], "left")
    return j.select(F.col("id").alias("product_key"), "name",
                    (F.col("amount") * F.col("_rows")).cast("double").alias("count_of_sales"),
                    repeated(F.col("revenue_dec"), F.col("_rows")).alias("total_revenue"))


def product_performance_as_written(products: DataFrame, fact: DataFrame) -> DataFrame:
    """M2 as the warehouse script states it: ``ON foi.product_key = product_key`` compares the
    fact column with itself, so every product meets every fact row with a product key and gets
    the grand total. Computed as one global aggregate read through scalar subqueries (the two
    subqueries over the same aggregate are merged by the optimizer), not as a product x fact
    nested-loop join."""
    tot = (fact.where(F.col("product_key").isNotNull())
           .agg(F.sum("amount").alias("amount"), money_sum_dec("fixed_total").alias("revenue_dec")))
    p = _products_by_id(products)
    return p.select(F.col("id").alias("product_key"), "name",
                    (tot.select("amount").scalar() * F.col("_rows")).cast("double").alias("count_of_sales"),
                    repeated(tot.select("revenue_dec").scalar(), F.col("_rows")).alias("total_revenue"))


def category_performance(dim_product_categories: DataFrame, dim_products: DataFrame, fact: DataFrame) -> DataFrame:
    """M3: ``categories ⟕ products ⟕ fact GROUP BY category ORDER BY total_revenue DESC,
    count_of_sales DESC`` (NULLs first under DESC, as in the warehouse). Categories without
    sales stay, with NULL sums."""
    return category_performance_of(dim_product_categories, dim_products, sales_by_product(fact)).orderBy(
        F.col("total_revenue").desc_nulls_first(), F.col("count_of_sales").desc_nulls_first())


def category_performance_of(dim_product_categories: DataFrame, dim_products: DataFrame, sales: DataFrame) -> DataFrame:
    """M3, unordered, from sums (product_key, amount, revenue_dec)."""
    prod = dim_products.select("products_key", "product_categories_key")
    per_cat = (prod.join(sales, prod["products_key"] == sales["product_key"], "left")
               .groupBy("product_categories_key")
               .agg(F.sum("amount").alias("amount"), F.sum("revenue_dec").alias("revenue_dec")))
    cats = dim_product_categories.groupBy("product_categories_key").agg(F.max("name").alias("name"),
                                                                        F.count(F.lit(1)).alias("_rows"))
    j = cats.join(per_cat, "product_categories_key", "left")
    return j.select(F.col("product_categories_key").alias("category_key"), "name",
                   (F.col("amount") * F.col("_rows")).cast("double").alias("count_of_sales"),
                   repeated(F.col("revenue_dec"), F.col("_rows")).alias("total_revenue"))
