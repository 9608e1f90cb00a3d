"""Daily revenue marts of the presentation layer (M4-M7).

All four are inner star joins of the sales fact with dim_date and the product-side
dimensions, grouped by day and a dimension key. The plan aggregates the fact first:

1. ``fact GROUP BY date_key[, product_key]``, with partial aggregation before the shuffle, so a
   day or a product holding a third of all rows reaches its reducer as one row per map task;
2. the per-(day, product) rows are joined to products once (``daily_product_sales``); the
   warehouse job checkpoints that table and derives all four marts from it, so M5-M7 are
   aggregations down to (day, key) followed by small name lookups.

``date_key`` and ``date`` are one-to-one in dim_date (the key is built from the day), and
products, suppliers and categories are unique on their keys, so grouping by ``date_key`` and
keys first gives the same groups as grouping by ``date`` after the joins.
Revenue sums are exact (decimal) and stored as DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions.money import money_sum_dec

# dim_date has one row per calendar day: at most 366 rows per year of the DATE range
# (years 1..9999: under 3.7 million rows of two columns), whatever the data volume.


def _per_day(fact: DataFrame, *keys: str) -> DataFrame:
    return (fact.groupBy("date_key", *keys)
            .agg(F.sum("amount").alias("amount"), money_sum_dec("fixed_total").alias("revenue_dec")))


def _days(dim_date: DataFrame) -> DataFrame:
    """(date_key, date), broadcast: bounded by the calendar (see above), no check needed."""
    return F.broadcast(dim_date.select("date_key", "date"))


def _out(df: DataFrame, *cols) -> DataFrame:
    return df.select(*cols, F.col("amount").cast("bigint").alias("amount"),
                     F.col("revenue_dec").cast("double").alias("revenue"))


def daily_product_sales(fact: DataFrame, dim_date: DataFrame, dim_products: DataFrame) -> DataFrame:
    """The shared base of the four marts: sales per day and product, with the product's name,
    category key and supplier key (NULL product columns where the fact's product is unknown).

    (date_key, date, amount, revenue_dec, products_key, product_name, product_categories_key,
    suppliers_key). The fact is aggregated and joined to products once; the marts are then
    aggregations of this table (and small name lookups), not four more passes over the fact."""
    return with_products(_per_day(fact, "product_key"), dim_date, dim_products)


def with_products(per_day: DataFrame, dim_date: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Sums by (date_key, product_key) with their day and the columns of their product."""
    per = per_day.join(_days(dim_date), "date_key")
    p = dim_products.select("products_key", F.col("name").alias("product_name"),
                            "product_categories_key", "suppliers_key")
    return per.join(p, per["product_key"] == p["products_key"], "left").drop("product_key")


def _matched(sales: DataFrame) -> DataFrame:
    """Rows whose product exists (the marts join products with an inner join)."""
    return sales.where(F.col("products_key").isNotNull())


def _sum_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("amount").alias("amount"), F.sum("revenue_dec").alias("revenue_dec"))


def _categories(dim_product_categories: DataFrame) -> DataFrame:
    return dim_product_categories.select("product_categories_key", F.col("name").alias("category"))


def revenue_by_day(sales: DataFrame) -> DataFrame:
    """M5 from the shared base."""
    return _out(_sum_by(sales, "date"), "date")


def revenue_by_day_product(sales: DataFrame, dim_suppliers: DataFrame, dim_product_categories: DataFrame) -> DataFrame:
    """M4 from the shared base (one row per day and product already)."""
    s = dim_suppliers.select("suppliers_key", F.col("name").alias("suppliers"))
    j = _matched(sales).join(s, "suppliers_key").join(_categories(dim_product_categories), "product_categories_key")
    return _out(j, "date", "product_name", "category", "suppliers")


def revenue_by_day_category(sales: DataFrame, dim_product_categories: DataFrame) -> DataFrame:
    """M6 from the shared base: partial aggregation down to (day, category) before any join."""
    g = _sum_by(_matched(sales), "date", "product_categories_key")
    return _out(g.join(_categories(dim_product_categories), "product_categories_key"), "date", "category")


def revenue_by_day_supplier(sales: DataFrame, dim_suppliers: DataFrame) -> DataFrame:
    """M7, keyed, from the shared base."""
    g = _sum_by(_matched(sales), "date", "suppliers_key")
    s = dim_suppliers.select("suppliers_key", F.col("name").alias("supplier_name"), "country")
    return _out(g.join(s, "suppliers_key"), "date", "supplier_name", "country")


# The marts from the fact directly (one query each).
def daily_revenue(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """M5: (date, amount, revenue). Needs no product join, so it aggregates the fact by day."""
    per_day = _per_day(fact).join(_days(dim_date), "date_key")
    return _out(_sum_by(per_day, "date"), "date")


def daily_revenue_per_product(fact: DataFrame, dim_date: DataFrame, dim_products: DataFrame,
                              dim_suppliers: DataFrame, dim_product_categories: DataFrame) -> DataFrame:
    """M4: (date, product_name, category, suppliers, amount, revenue), one row per day and product."""
    return revenue_by_day_product(daily_product_sales(fact, dim_date, dim_products), dim_suppliers,
                                  dim_product_categories)


def daily_revenue_per_category(fact: DataFrame, dim_date: DataFrame, dim_products: DataFrame,
                               dim_product_categories: DataFrame) -> DataFrame:
    """M6: (date, category, amount, revenue), one row per day and category."""
    return revenue_by_day_category(daily_product_sales(fact, dim_date, dim_products), dim_product_categories)


def daily_revenue_per_supplier(fact: DataFrame, dim_date: DataFrame, dim_products: DataFrame,
                               dim_suppliers: DataFrame) -> DataFrame:
    """M7, keyed (``ds.suppliers_key = dp.suppliers_key``): (date, supplier_name, country,
    amount, revenue), one row per day and supplier.

    The script's own predicate ``dp.suppliers_key = dp.suppliers_key`` pairs every day with
    every supplier; that Cartesian form is not built (see README)."""
    return revenue_by_day_supplier(daily_product_sales(fact, dim_date, dim_products), dim_suppliers)
