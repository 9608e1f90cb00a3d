"""The alternative model of schema ``dbo`` (D9, M8-M10 and its dimensions).

Its dimensions are plain projections of the raw tables (no upserts, no full name, TIMESTAMP
kept). Two of its facts join on wrong predicates in the source script; the keyed forms are
the default and the as-written forms are kept where they do not pair every row with every
row (see README for the one that is not built).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.dates import date_key
from tillstar.functions.money import repeated


def dim_customers(customer: DataFrame) -> DataFrame:
    return customer.select(F.col("id").alias("customers_key"), "first_name", "last_name", "gender", "address", "zip_code")


def dim_login_attempts(logins: DataFrame) -> DataFrame:
    return logins.select(F.col("id").alias("login_attempts_key"), "customer_id",
                         F.col("login_successful").alias("login_successfull"), "attempted_at")


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(F.col("id").alias("product_key"), "name", "price", "category_id", "supplier_id")


def dim_product_categories(categories: DataFrame) -> DataFrame:
    return categories.select(F.col("id").alias("product_categories_key"), "name")


def dim_suppliers(suppliers: DataFrame) -> DataFrame:
    return suppliers.select(F.col("id").alias("suppliers_key"), "name", "country")


def dim_orders(orders: DataFrame) -> DataFrame:
    """customer_id stays text, created_at stays a timestamp."""
    return orders.select(F.col("id").alias("orders_key"), "customer_id", "status", "created_at")


def dim_order_items(order_items: DataFrame) -> DataFrame:
    """D9 (loaded by append)."""
    return order_items.select(F.col("id").alias("order_items_key"), "order_id", "product_id", "amount", "coupon_id")


def dim_coupons(coupons: DataFrame) -> DataFrame:
    return coupons.select(F.col("id").alias("coupons_key"), "discount_percent")


def sale_lines(dim_orders_erd: DataFrame, dim_order_items_erd: DataFrame, dim_product_erd: DataFrame) -> DataFrame:
    """M8, re-aimed to item grain: ``orders ⟕ items ON items.order_id = orders.orders_key
    ⟕ product ON product.product_key = items.product_id``; sale_amount is DECIMAL(10,2)
    (an over-range quantity fails, as the declared column would), stored as DOUBLE.

    Written as (items ⋈ orders) ⟕ product, plus the orders that have no item: the item side
    stays the preserved or inner side of every join, so AQE may split a hot order, and the
    anti join reads the distinct item order ids (collapsed before the shuffle)."""
    o = dim_orders_erd.select("orders_key", "created_at", "status")
    items = dim_order_items_erd.select("order_items_key", "order_id", "product_id", "amount")
    prod = dim_product_erd.select("product_key")
    lines = (items.join(o, items["order_id"] == o["orders_key"])
             .join(prod, F.col("product_id") == prod["product_key"], "left"))
    cols = lambda df: df.select(
        F.col("orders_key").alias("order_key"),
        date_key(F.col("created_at")).alias("date_key"),
        F.col("product_key"),
        F.col("order_items_key"),
        F.col("amount").cast("decimal(10,2)").cast("double").alias("sale_amount"),
        F.col("status").alias("status_order"))
    with_items = cols(lines)
    no_items = o.join(items.select(F.col("order_id").alias("orders_key")).distinct(), "orders_key", "left_anti")
    bare = no_items.select("orders_key", "created_at", "status",
                           F.lit(None).cast("bigint").alias("product_key"),
                           F.lit(None).cast("bigint").alias("order_items_key"),
                           F.lit(None).cast("bigint").alias("amount"))
    return with_items.unionByName(cols(bare))


def _revenue(qty: Column, price: Column) -> Column:
    """qty * price, exact, as decimal(38,15): a price counts with 15 decimals, one of 100 million or more with six."""
    large = (qty * price.cast("decimal(23,6)")).cast("decimal(38,15)")
    return F.when(F.abs(price) < 100_000_000, qty * price.cast("decimal(23,15)")).otherwise(large)


def _category_revenue(dim_product_categories_erd: DataFrame, dim_product_erd: DataFrame,
                      dim_order_items_erd: DataFrame, product_on: str) -> DataFrame:
    qty = (dim_order_items_erd.groupBy("product_id")
           .agg(F.sum(F.col("amount").cast("decimal(12,0)")).cast("decimal(14,0)").alias("qty")))
    prod = dim_product_erd.select("product_key", F.col(product_on).alias("_cat"), "price")
    per_product = (prod.join(qty, prod["product_key"] == qty["product_id"], "left")
                   .select("_cat", _revenue(F.col("qty"), F.col("price")).alias("rev")))
    per_cat = per_product.groupBy("_cat").agg(F.sum("rev").alias("rev"))
    cats = (dim_product_categories_erd.groupBy("product_categories_key", "name")
            .agg(F.count(F.lit(1)).alias("_rows")))
    j = cats.join(per_cat, cats["product_categories_key"] == per_cat["_cat"], "left")
    return j.select(F.col("product_categories_key").alias("category_performance_key"),
                    F.col("name").alias("product_categories_name"),
                    repeated(F.col("rev"), F.col("_rows")).alias("total_revenue"))


def category_revenue(dim_product_categories_erd: DataFrame, dim_product_erd: DataFrame,
                     dim_order_items_erd: DataFrame) -> DataFrame:
    """M9, keyed: gross revenue (price x amount, no coupon) per category, categories ⟕
    products (on category_id) ⟕ items, grouped by category key and name."""
    return _category_revenue(dim_product_categories_erd, dim_product_erd, dim_order_items_erd, "category_id")


def category_revenue_as_written(dim_product_categories_erd: DataFrame, dim_product_erd: DataFrame,
                                dim_order_items_erd: DataFrame) -> DataFrame:
    """M9 as the script joins it: category key = **product** key."""
    return _category_revenue(dim_product_categories_erd, dim_product_erd, dim_order_items_erd, "product_key")


def customer_activity(dim_login_attempts_erd: DataFrame) -> DataFrame:
    """M10. The script stores the success flag in ``orders_key`` and the time in
    ``login_attempts_key``; the values are kept under the names they hold."""
    return dim_login_attempts_erd.select(F.col("login_attempts_key").alias("customer_activity_key"),
                                         F.col("customer_id").alias("customers_key"),
                                         F.col("login_successfull").alias("login_successful"),
                                         "attempted_at")
