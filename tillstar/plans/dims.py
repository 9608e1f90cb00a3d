"""Dimensions of the star model (D1-D8). Every function maps raw DataFrames to a dimension
DataFrame with the column names and types of ``schemas.STAR``; loading is separate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions.dates import calendar_columns
from tillstar.functions.text import full_name


def dim_coupons(coupons: DataFrame) -> DataFrame:
    """D1."""
    return coupons.select(F.col("id").cast("bigint").alias("coupon_key"),
                          F.col("discount_percent").cast("double").alias("discount_percent"))


def order_days(orders: DataFrame) -> DataFrame:
    """Distinct order days. By day, not by timestamp: two orders at different times of one
    day must give one dim_date row (the key is the day)."""
    return orders.select(F.to_date("created_at").alias("day")).where(F.col("day").isNotNull()).distinct()


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per order day; partial distinct before the shuffle, so a day holding a third
    of all orders ships one row per map task."""
    return order_days(orders).select(*calendar_columns(F.col("day")))


def dim_customers(customer: DataFrame) -> DataFrame:
    """full_name = CONCAT(first, ' ', last) with NULL as empty text."""
    return customer.select(F.col("id").cast("bigint").alias("customers_key"),
                           full_name("first_name", "last_name").alias("full_name"),
                           "first_name", "last_name", "gender", "address", "zip_code")


def _login_projection(df: DataFrame) -> DataFrame:
    return df.select(F.col("id").cast("bigint").alias("login_key"),
                     F.col("customer_id").cast("bigint").alias("customer_key"),
                     F.col("login_successful"),
                     F.to_date("attempted_at").alias("attempted_at"))


def dim_login_attempts(logins: DataFrame, customer: DataFrame) -> DataFrame:
    """D3 as the warehouse defines it: ``customer_id < (SELECT MAX(id) FROM customer)``.

    Strict: the highest customer and NULL customer ids are left out. The max is an
    uncorrelated scalar subquery (run once, pushed into the scan as a filter)."""
    max_id = customer.select(F.max("id")).scalar()
    return _login_projection(logins.where(F.col("customer_id") < max_id))


def dim_login_attempts_known(logins: DataFrame, customer: DataFrame) -> DataFrame:
    """D3, intended form: keep attempts whose customer exists (left semi join)."""
    known = logins.join(customer.select(F.col("id").alias("customer_id")), "customer_id", "left_semi")
    return _login_projection(known)


def dim_product_categories(categories: DataFrame) -> DataFrame:
    """D5."""
    return categories.select(F.col("id").cast("bigint").alias("product_categories_key"), "name")


def dim_suppliers(suppliers: DataFrame) -> DataFrame:
    """D6."""
    return suppliers.select(F.col("id").cast("bigint").alias("suppliers_key"), "name", "country")


def dim_products(products: DataFrame) -> DataFrame:
    """D7."""
    return products.select(F.col("id").cast("bigint").alias("products_key"), "name",
                           F.col("price").cast("double").alias("price"),
                           F.col("category_id").cast("bigint").alias("product_categories_key"),
                           F.col("supplier_id").cast("bigint").alias("suppliers_key"))


def dim_orders(orders: DataFrame) -> DataFrame:
    """The text customer id is cast to BIGINT (a malformed id fails the job, as in SQL);
    created_at is truncated to its day."""
    return orders.select(F.col("id").cast("bigint").alias("order_key"),
                         F.col("customer_id").cast("bigint").alias("customers_key"),
                         "status",
                         F.to_date("created_at").alias("created_at"))


# name -> builder over the raw tables
BUILDERS = {
    "dim_coupons": lambda raw: dim_coupons(raw["coupons"]),
    "dim_date": lambda raw: dim_date(raw["orders"]),
    "dim_customers": lambda raw: dim_customers(raw["customer"]),
    "dim_login_attempts": lambda raw: dim_login_attempts(raw["login_attemps"], raw["customer"]),
    "dim_product_categories": lambda raw: dim_product_categories(raw["product_categories"]),
    "dim_suppliers": lambda raw: dim_suppliers(raw["suppliers"]),
    "dim_products": lambda raw: dim_products(raw["products"]),
    "dim_orders": lambda raw: dim_orders(raw["orders"]),
}


class LazyDims(dict):
    """Mapping name -> dimension DataFrame, each built on first access (building a plan may
    run a small size check, so only the dimensions a query uses are built)."""

    def __init__(self, raw):
        super().__init__()
        self._raw = raw

    def __missing__(self, name: str) -> DataFrame:
        df = BUILDERS[name](self._raw)
        self[name] = df
        return df


def build_all(raw) -> LazyDims:
    """All star dimensions from the raw tables, built lazily."""
    return LazyDims(raw)
