"""Registered queries: one per operator / model of the inventory, each over whole test tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame. Queries of sources and
loaders first write data that Spark derives from the test tables (CSV, JSON, parquet files or
catalog tables below the shared scratch folder), then read it back through the operator.
The oracle SQL for each name is in ``tillstar.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.functions.money import money_text
from tillstar.operators import footers, keysets, load, quality, versions
from tillstar.operators.dedup import keep_last
from tillstar.plans import dims, erd, facts, marts, warehouse
from tillstar.session import new_scratch_dir, reliable_checkpoint
from tillstar.sources import dirty, files
from tillstar.sources.testdata import ITEM_VERSION, SourceTables


class Model:
    """The star and ERD models over one scale-factor folder, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = SourceTables(spark, sf_dir)

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return self.t.raw()

    @cached_property
    def star(self) -> dict[str, DataFrame]:
        return dims.build_all(self.raw)

    @cached_property
    def fact(self) -> DataFrame:
        d = self.star
        return facts.fact_sales_orders(self.raw["order_items"], d["dim_products"], d["dim_orders"],
                                       d["dim_customers"], d["dim_coupons"])

    @cached_property
    def sales(self) -> DataFrame:
        """The sales fact for marts and sums: without the customer join, which they do not need."""
        d = self.star
        return facts.fact_sales_orders(self.raw["order_items"], d["dim_products"], d["dim_orders"], None, d["dim_coupons"])

    @cached_property
    def erd(self) -> dict[str, DataFrame]:
        r = self.raw
        return {
            "dim_customers": erd.dim_customers(r["customer"]),
            "dim_login_attempts": erd.dim_login_attempts(r["login_attemps"]),
            "dim_product": erd.dim_product(r["products"]),
            "dim_product_categories": erd.dim_product_categories(r["product_categories"]),
            "dim_suppliers": erd.dim_suppliers(r["suppliers"]),
            "dim_orders": erd.dim_orders(r["orders"]),
            "dim_order_items": erd.dim_order_items(r["order_items"]),
            "dim_coupons": erd.dim_coupons(r["coupons"]),
            "dim_date": dims.dim_date(r["orders"]),
        }


def _star_dim(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Model(spark, sf_dir).star[name]
    q.__name__ = name
    return q


# ----------------------------------------------------------------- dimensions
def dim_login_attempts_known(spark, sf_dir):
    m = Model(spark, sf_dir)
    return dims.dim_login_attempts_known(m.raw["login_attemps"], m.raw["customer"])


def dim_order_items(spark, sf_dir):
    return Model(spark, sf_dir).erd["dim_order_items"]


# ----------------------------------------------------------------- facts and marts
def fact_sales_orders(spark, sf_dir):
    return Model(spark, sf_dir).fact


def product_performance(spark, sf_dir):
    m = Model(spark, sf_dir)
    return facts.product_performance(m.raw["products"], m.sales)


def product_performance_as_written(spark, sf_dir):
    m = Model(spark, sf_dir)
    return facts.product_performance_as_written(m.raw["products"], m.sales)


def category_performance(spark, sf_dir):
    m = Model(spark, sf_dir)
    return facts.category_performance(m.star["dim_product_categories"], m.star["dim_products"], m.sales)


def daily_revenue(spark, sf_dir):
    m = Model(spark, sf_dir)
    return marts.daily_revenue(m.sales, m.star["dim_date"])


def daily_revenue_per_product(spark, sf_dir):
    m = Model(spark, sf_dir)
    d = m.star
    return marts.daily_revenue_per_product(m.sales, d["dim_date"], d["dim_products"], d["dim_suppliers"],
                                           d["dim_product_categories"])


def daily_revenue_per_category(spark, sf_dir):
    m = Model(spark, sf_dir)
    d = m.star
    return marts.daily_revenue_per_category(m.sales, d["dim_date"], d["dim_products"], d["dim_product_categories"])


def daily_revenue_per_supplier(spark, sf_dir):
    m = Model(spark, sf_dir)
    d = m.star
    return marts.daily_revenue_per_supplier(m.sales, d["dim_date"], d["dim_products"], d["dim_suppliers"])


def sale_lines_erd(spark, sf_dir):
    e = Model(spark, sf_dir).erd
    return erd.sale_lines(e["dim_orders"], e["dim_order_items"], e["dim_product"])


def category_revenue_erd(spark, sf_dir):
    e = Model(spark, sf_dir).erd
    return erd.category_revenue(e["dim_product_categories"], e["dim_product"], e["dim_order_items"])


def category_revenue_erd_as_written(spark, sf_dir):
    e = Model(spark, sf_dir).erd
    return erd.category_revenue_as_written(e["dim_product_categories"], e["dim_product"], e["dim_order_items"])


def customer_activity(spark, sf_dir):
    return erd.customer_activity(Model(spark, sf_dir).erd["dim_login_attempts"])


# ----------------------------------------------------------------- cleaning, sources
def dedup_keep_last(spark, sf_dir):
    """P6 over all lineitem-derived order item versions."""
    t = SourceTables(spark, sf_dir)
    return keep_last(t.order_item_versions, ["id"], ITEM_VERSION).drop(*ITEM_VERSION)


def union_by_name(spark, sf_dir):
    """Customers arriving in two layouts (the second in another column order and without
    zip codes) concatenated by name."""
    c = SourceTables(spark, sf_dir).customer
    a = c.where(F.col("zip_code") < "00013")
    b = c.where(F.col("zip_code") >= "00013").select("gender", "address", "last_name", "first_name", "id")
    return files.union_all_by_name([a, b])


def scan_csv_multi(spark, sf_dir):
    """Customers written as 10 CSV files with an unnamed index column, read back."""
    path = new_scratch_dir(spark, "customer-csv")
    files.write_csv(SourceTables(spark, sf_dir).customer, path, num_files=10, index_column=True)
    return files.read_csv(spark, path, schemas.RAW["customer"], index_column=True)


def scan_json_columns(spark, sf_dir):
    """Coupons written as column-oriented JSON documents, read back."""
    path = new_scratch_dir(spark, "coupons-json")
    files.write_json_columns(SourceTables(spark, sf_dir).coupons, path, num_files=2)
    return files.read_json_columns(spark, path, schemas.RAW["coupons"])


def scan_json_columns_logins(spark, sf_dir):
    """S3 in its default layout: login attempts written as 10 column-oriented JSON files (one
    document per Arrow batch, timestamps as ISO text), read back."""
    path = new_scratch_dir(spark, "logins-json-columns")
    files.write_json_columns(SourceTables(spark, sf_dir).login_attemps, path, num_files=10)
    return files.read_json_columns(spark, path, schemas.RAW["login_attemps"])


def scan_json_records(spark, sf_dir):
    """S3: login attempts written as 10 JSON-lines files, read back."""
    path = new_scratch_dir(spark, "logins-json")
    files.write_json_records(SourceTables(spark, sf_dir).login_attemps, path, num_files=10)
    return files.read_json_records(spark, path, schemas.RAW["login_attemps"])


def scan_parquet(spark, sf_dir):
    """Orders written as parquet, read back."""
    path = new_scratch_dir(spark, "orders-parquet")
    SourceTables(spark, sf_dir).orders.write.mode("overwrite").parquet(path)
    return files.read_parquet(spark, path, schemas.RAW["orders"])


def scan_avro(spark, sf_dir):
    """Order items written as Avro container files in small blocks, read back by many tasks a file."""
    path = new_scratch_dir(spark, "items-avro")
    files.write_avro(SourceTables(spark, sf_dir).order_items, path, num_files=4, block_bytes=16 << 10)
    return files.read_avro(spark, path, schemas.RAW["order_items"], split_bytes=128 << 10)


def stream_ingest_logins(spark, sf_dir):
    """Streaming ingest (Structured Streaming, foreachBatch keep-last + upsert): login attempts
    land in two batches, first a stale version of every attempt (success flag inverted), then
    the current one; after both runs the table holds the current rows."""
    from tillstar.streaming.ingest import start_ingest

    root = new_scratch_dir(spark, "stream-logins")
    logins = SourceTables(spark, sf_dir).login_attemps
    db = _database(spark, "stream")
    table = f"{db}.login_attemps"
    for i, batch in enumerate((logins.withColumn("login_successful", ~F.col("login_successful")), logins)):
        files.write_json_records(batch, f"{root}/landing/batch={i}", num_files=4)
        q = start_ingest(spark, "login_attemps", "json_records", f"{root}/landing/*", table, f"{root}/checkpoint")
        q.awaitTermination()      # the trigger ends the stream after the files that are there
        if q.exception():
            raise RuntimeError(f"stream failed: {q.exception()}")
    spark.catalog.refreshTable(table)      # the micro-batches swapped it in the stream's session
    return spark.table(table)


# ----------------------------------------------------------------- loading
def _database(spark: SparkSession, label: str) -> str:
    path = new_scratch_dir(spark, label)
    db = f"{label}_{path.rsplit('-', 1)[-1]}"
    load.create_layer(spark, db, path)
    return db


def load_replace(spark, sf_dir):
    """K1: a stale load of orders replaced by the current one."""
    t = SourceTables(spark, sf_dir)
    table = f"{_database(spark, 'raw')}.orders"
    load.replace(t.orders.withColumn("status", F.lower("status")), table)
    load.replace(t.orders, table)
    return spark.table(table)


def load_append(spark, sf_dir):
    """K2: a mart without a key inserted twice (a re-run of ``INSERT ... SELECT`` adds its rows again). The mart itself is
    computed once."""
    mart = reliable_checkpoint(daily_revenue_per_category(spark, sf_dir))
    table = f"{_database(spark, 'presentation')}.daily_order_revenue_per_categories"
    load.append(mart, table)
    load.append(mart, table)
    return spark.table(table)


def load_append_once(spark, sf_dir):
    """K2, exactly once: the same mart in two batches, the second one sent twice; a batch id that is known adds nothing.
    The mart itself is computed once."""
    mart = reliable_checkpoint(daily_revenue_per_supplier(spark, sf_dir))
    table = f"{_database(spark, 'presentation')}.daily_order_revenue_per_suppliers"
    versions.append_once(spark, table, mart.where(F.year("date") < 1996), "until-1995")
    for _ in range(2):
        versions.append_once(spark, table, mart.where(F.year("date") >= 1996), "from-1996")
    return spark.table(table)


def load_append_keyed(spark, sf_dir):
    """K2 with a primary key: items in two batches; a third one that repeats stored items is rejected whole, by the
    key's bitmaps and without reading the table."""
    items = Model(spark, sf_dir).erd["dim_order_items"]
    table = f"{_database(spark, 'dbo')}.dim_order_items"
    even, odd = items.where("order_id % 2 = 0"), items.where("order_id % 2 = 1")
    keysets.append_keyed(spark, table, even, "order_items_key", "even")
    keysets.append_keyed(spark, table, odd, "order_items_key", "odd")
    try:
        keysets.append_keyed(spark, table, items.where("order_id % 3 = 0"), "order_items_key", "again")
    except ValueError as e:
        if "primary key violation" in str(e):
            return spark.table(table)
        raise
    raise AssertionError("items that the table has were appended again")


def max_customer_id(spark, sf_dir):
    """A3 from file footers: MAX(id) of stored customers without reading a column."""
    path = new_scratch_dir(spark, "customers")
    SourceTables(spark, sf_dir).customer.write.mode("overwrite").parquet(path)
    return footers.max_of(spark, [path], "id").select(F.col("max").alias("max_id"))


def load_overwrite_partitions(spark, sf_dir):
    """K2, re-run safe: the per-category mart loaded twice into a table partitioned by month;
    the second load replaces the months it brings, so the rows stay once. The mart itself is computed once."""
    mart = reliable_checkpoint(daily_revenue_per_category(spark, sf_dir))
    stored = mart.withColumn("year", F.year("date")).withColumn("month", F.month("date"))
    table = f"{_database(spark, 'presentation')}.daily_order_revenue_per_categories"
    load.overwrite_partitions(stored, table, ["year", "month"])
    load.overwrite_partitions(stored, table, ["year", "month"])
    return spark.table(table).select(*mart.columns)


# Two overlapping order batches for the upsert: the first load holds orders created before
# UPSERT_TARGET_BEFORE, the second brings every order from UPSERT_SOURCE_FROM on, with
# open orders now fulfilled and a changed customer id that the upsert must not apply.
UPSERT_TARGET_BEFORE = "1999-01-01"
UPSERT_SOURCE_FROM = "1997-01-01"


def upsert_source(dim_orders: DataFrame) -> DataFrame:
    return (dim_orders.where(F.col("created_at") >= F.lit(UPSERT_SOURCE_FROM).cast("date"))
            .select("order_key", (F.col("customers_key") + 1).alias("customers_key"),
                    F.when(F.col("status") == "O", F.lit("F")).otherwise(F.col("status")).alias("status"),
                    "created_at"))


def upsert_orders_subset(spark, sf_dir):
    """K3: upsert of dim_orders updating (status, created_at) only, through staging + swap."""
    d = Model(spark, sf_dir).star["dim_orders"]
    table = f"{_database(spark, 'dimensional')}.dim_orders"
    load.replace(d.where(F.col("created_at") < F.lit(UPSERT_TARGET_BEFORE).cast("date")), table)
    load.upsert_table(spark, table, upsert_source(d), ["order_key"], ["status", "created_at"])
    return spark.table(table)


# Consecutive order keys that ``touched`` tells of.
TOUCHED_RANGE = 256


def upsert_partitions_incremental(spark, sf_dir):
    """K3 on a table in versions, partitioned and bucketed by its key as the warehouse stores it: the orders of the first
    load, then the whole batch of ``upsert_source``, which merges with the partitions that it touches. ``touched`` tells
    for each row whether the batch's version inserted or updated a row of its range of keys, by the marks which that
    version's files keep."""
    d = Model(spark, sf_dir).star["dim_orders"]
    keyed = lambda df: warehouse.with_key_range(df, "order_key").withColumn("part", F.floor(F.col("order_key") / TOUCHED_RANGE))
    table = f"{_database(spark, 'dimensional')}.dim_orders"
    layout = warehouse.layout_of("dim_orders")
    later = F.coalesce(F.col("created_at") >= F.lit(UPSERT_TARGET_BEFORE).cast("date"), F.lit(False))
    first = versions.upsert_versioned(spark, table, keyed(d.where(~later)), ["order_key"], ["status", "created_at"], layout)
    versions.upsert_versioned(spark, table, keyed(upsert_source(d)), ["order_key"], ["status", "created_at"], layout, remember=("status",))
    named = versions.changes(spark, table, first, ["part"], ["status"]).where("sign = 1")
    touched = named.select("part", F.lit(True).alias("touched")).distinct()
    return (spark.table(table).join(touched, "part", "left")
            .select("order_key", "customers_key", "status", "created_at", F.coalesce("touched", F.lit(False)).alias("touched")))


def sales_with_odd_prices(spark, sf_dir):
    """M1's money columns with prices that are no short decimals (a seventh, binary noise) and odd discounts."""
    m = Model(spark, sf_dir)
    d = m.star
    products = d["dim_products"].withColumn("price", odd_price(F.col("price"), F.col("products_key")))
    coupons = d["dim_coupons"].withColumn("discount_percent", F.col("discount_percent") / 8)
    fact = facts.fact_sales_orders(m.raw["order_items"], products, d["dim_orders"], None, coupons)
    return fact.select("sale_order_key", "price_per_unit", "total", "discount", "fixed_total")


def category_revenue_odd_prices(spark, sf_dir):
    """M9 with the same prices."""
    e = Model(spark, sf_dir).erd
    products = e["dim_product"].withColumn("price", odd_price(F.col("price"), F.col("product_key")))
    return erd.category_revenue(e["dim_product_categories"], products, e["dim_order_items"])


def odd_price(price, key):
    return F.when(key % 3 == 0, price / 7).when(key % 3 == 1, F.lit(0.1) + F.lit(0.2)).otherwise(price * 0.00012345)


def daily_revenue_as_text(spark, sf_dir):
    """M5 as its table is declared: revenue as TEXT with two decimals."""
    return daily_revenue(spark, sf_dir).withColumn("revenue", money_text("revenue"))


def scan_catalogue_sheets(spark, sf_dir):
    """The three catalogue sheets as CSV exports with an unnamed index column, read back and joined by key."""
    t = SourceTables(spark, sf_dir)
    back = {}
    for name in ("product_categories", "products", "suppliers"):
        path = new_scratch_dir(spark, f"sheet-{name}")
        files.write_csv(getattr(t, name), path, num_files=1)
        back[name] = files.read_csv(spark, path, schemas.RAW[name])
    c = back["product_categories"].select(F.col("id").alias("category_id"), F.col("name").alias("category"))
    s = back["suppliers"].select(F.col("id").alias("supplier_id"), F.col("name").alias("supplier"), "country")
    return back["products"].join(c, "category_id", "left").join(s, "supplier_id", "left").select("id", "name", "price", "category", "supplier", "country")


# ----------------------------------------------------------------- constraint checks
def check_primary_key(spark, sf_dir):
    """Duplicate order item ids among all lineitem-derived versions."""
    return quality.check_primary_key(SourceTables(spark, sf_dir).order_item_versions.select("id"), ["id"])


def _star_fk_checks(m: Model):
    d, f = m.star, m.fact
    return [
        ("fact_sales_orders.order_key", f, "order_key", d["dim_orders"], "order_key"),
        ("fact_sales_orders.customers_key", f, "customers_key", d["dim_customers"], "customers_key"),
        ("fact_sales_orders.product_key", f, "product_key", d["dim_products"], "products_key"),
        ("fact_sales_orders.coupon_key", f, "coupon_key", d["dim_coupons"], "coupon_key"),
        ("fact_sales_orders.date_key", f, "date_key", d["dim_date"], "date_key"),
        ("dim_products.product_categories_key", d["dim_products"], "product_categories_key",
         d["dim_product_categories"], "product_categories_key"),
        ("dim_products.suppliers_key", d["dim_products"], "suppliers_key", d["dim_suppliers"], "suppliers_key"),
        ("dim_orders.customers_key", d["dim_orders"], "customers_key", d["dim_customers"], "customers_key"),
        ("dim_login_attempts.customer_key", d["dim_login_attempts"], "customer_key",
         d["dim_customers"], "customers_key"),
        ("order_items.order_id", m.raw["order_items"], "order_id", m.raw["orders"], "id"),
        ("order_items.product_id", m.raw["order_items"], "product_id", m.raw["products"], "id"),
        ("order_items.coupon_id", m.raw["order_items"], "coupon_id", m.raw["coupons"], "id"),
    ]


def check_foreign_key(spark, sf_dir):
    """C2 report over the star model's foreign keys and the raw item references."""
    return quality.foreign_key_report(_star_fk_checks(Model(spark, sf_dir)))


def _erd_tables(m: Model) -> dict[str, DataFrame]:
    e = dict(m.erd)
    e["fact_categories_performance"] = erd.category_revenue(e["dim_product_categories"], e["dim_product"],
                                                            e["dim_order_items"])
    return {f"dbo.{k}": v for k, v in e.items()}


def check_not_null(spark, sf_dir):
    """C3 report over every NOT NULL column of the dbo model."""
    m = Model(spark, sf_dir)
    tables = _erd_tables(m)
    return quality.not_null_report([(n, df, schemas.SPECS[n].not_null) for n, df in tables.items()])


def check_length(spark, sf_dir):
    """C4 report over every VARCHAR(n) column of both models."""
    m = Model(spark, sf_dir)
    tables = {f"dimensional.{k}": m.star[k] for k in dims.BUILDERS if schemas.SPECS[f"dimensional.{k}"].max_length}
    tables["dbo.dim_product"] = m.erd["dim_product"]
    return quality.length_report([(n, df, schemas.SPECS[n].max_length) for n, df in tables.items()
                                  if schemas.SPECS[n].max_length])


def check_decimal_range(spark, sf_dir):
    """C5 report: DECIMAL(10,2) columns of the dbo facts, checked before the cast."""
    m = Model(spark, sf_dir)
    e = _erd_tables(m)
    items = e["dbo.dim_order_items"].select(F.col("amount").alias("sale_amount"))
    return quality.decimal_range_report([
        ("dbo.fact_sale_orders", items, {"sale_amount": (10, 2)}),
        ("dbo.fact_categories_performance", e["dbo.fact_categories_performance"], {"total_revenue": (10, 2)}),
    ])


def _stored_tables(m: Model) -> dict[str, DataFrame]:
    """Every model table under its declared name."""
    d = {f"dimensional.{n}": m.star[n] for n in dims.BUILDERS}
    d["dimensional.fact_sales_orders"] = m.fact
    d["dimensional.fact_product_performance"] = facts.product_performance(m.raw["products"], m.sales)
    d["dimensional.fact_product_category_performance"] = facts.category_performance(m.star["dim_product_categories"], m.star["dim_products"], m.sales)
    d["presentation.daily_order_revenue"] = marts.daily_revenue(m.sales, m.star["dim_date"])
    d |= _erd_tables(m)
    d["dbo.fact_sale_orders"] = erd.sale_lines(m.erd["dim_orders"], m.erd["dim_order_items"], m.erd["dim_product"])
    d["dbo.fact_customer_activity"] = erd.customer_activity(m.erd["dim_login_attempts"])
    return d


def check_primary_key_all(spark, sf_dir):
    """C1 for all 24 declared keys, on tables with repeated and NULL keys."""
    tables = _stored_tables(Model(spark, sf_dir))
    return quality.primary_key_report([(n, dirty.keys_damaged(tables[n], schemas.SPECS[n], k), [k]) for n, k in schemas.declared_keys()])


def check_foreign_key_all(spark, sf_dir):
    """C2 for the 11 declared foreign keys, on children with orphans."""
    tables = _stored_tables(Model(spark, sf_dir))
    return quality.foreign_key_report([
        (f"{s.name}.{col}", dirty.orphaned(tables[s.name], s, s.primary_key[0], col), col, tables[parent], pcol)
        for s in schemas.STAR for col, parent, pcol in s.foreign_keys])


def check_foreign_key_batch(spark, sf_dir):
    """C2 of a batch: new orders, some of customers that do not exist, against the bitmaps of the stored customer keys."""
    m = Model(spark, sf_dir)
    table = f"{_database(spark, 'dimensional')}.dim_customers"
    layout = warehouse.layout_of("dim_customers")
    versions.upsert_versioned(spark, table, warehouse.with_key_range(m.star["dim_customers"], "customers_key"), ["customers_key"], ["address"], layout, ("address",))
    orders = m.star["dim_orders"]
    spec = schemas.SPECS["dimensional.dim_orders"]
    rows = orders.where("order_key % 4 = 0").select("order_key").join(orders, "order_key")
    return keysets.orphans(spark, [("dim_orders.customers_key", dirty.orphaned(rows, spec, "order_key", "customers_key"), "customers_key",
                                    keysets.sync(spark, table, "customers_key"))])


def check_not_null_all(spark, sf_dir):
    """C3 for every NOT NULL column of both models, on tables with NULLs."""
    tables = _stored_tables(Model(spark, sf_dir))
    return quality.not_null_report([(s.name, dirty.nulls(tables[s.name], s, s.primary_key[0]), s.not_null) for s in schemas.STAR + schemas.ERD if s.not_null])


def check_length_all(spark, sf_dir):
    """C4 for every VARCHAR(n) column, on tables with texts that are too long."""
    tables = _stored_tables(Model(spark, sf_dir))
    return quality.length_report([(s.name, dirty.overlong(tables[s.name], s, s.primary_key[0]), s.max_length) for s in schemas.STAR + schemas.ERD if s.max_length])


def check_decimal_range_all(spark, sf_dir):
    """C5 for both DECIMAL(10,2) columns, on tables with numbers beyond it."""
    tables = _stored_tables(Model(spark, sf_dir))
    return quality.decimal_range_report([
        ("dbo.fact_sale_orders", dirty.huge(tables["dbo.fact_sale_orders"], "order_key", "sale_amount"), {"sale_amount": (10, 2)}),
        ("dbo.fact_categories_performance", dirty.huge(tables["dbo.fact_categories_performance"], "category_performance_key", "total_revenue"), {"total_revenue": (10, 2)})])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dim_coupons": _star_dim("dim_coupons"),
    "dim_date": _star_dim("dim_date"),
    "dim_customers": _star_dim("dim_customers"),
    "dim_login_attempts": _star_dim("dim_login_attempts"),
    "dim_login_attempts_known": dim_login_attempts_known,
    "dim_product_categories": _star_dim("dim_product_categories"),
    "dim_suppliers": _star_dim("dim_suppliers"),
    "dim_products": _star_dim("dim_products"),
    "dim_orders": _star_dim("dim_orders"),
    "dim_order_items": dim_order_items,
    "fact_sales_orders": fact_sales_orders,
    "product_performance": product_performance,
    "product_performance_as_written": product_performance_as_written,
    "category_performance": category_performance,
    "daily_revenue": daily_revenue,
    "daily_revenue_per_product": daily_revenue_per_product,
    "daily_revenue_per_category": daily_revenue_per_category,
    "daily_revenue_per_supplier": daily_revenue_per_supplier,
    "sale_lines_erd": sale_lines_erd,
    "category_revenue_erd": category_revenue_erd,
    "category_revenue_erd_as_written": category_revenue_erd_as_written,
    "customer_activity": customer_activity,
    "dedup_keep_last": dedup_keep_last,
    "union_by_name": union_by_name,
    "scan_csv_multi": scan_csv_multi,
    "scan_json_columns": scan_json_columns,
    "scan_json_columns_logins": scan_json_columns_logins,
    "scan_json_records": scan_json_records,
    "scan_parquet": scan_parquet,
    "scan_avro": scan_avro,
    "stream_ingest_logins": stream_ingest_logins,
    "load_replace": load_replace,
    "load_append": load_append,
    "load_overwrite_partitions": load_overwrite_partitions,
    "upsert_orders_subset": upsert_orders_subset,
    "upsert_partitions_incremental": upsert_partitions_incremental,
    "check_primary_key": check_primary_key,
    "check_foreign_key": check_foreign_key,
    "check_not_null": check_not_null,
    "check_length": check_length,
    "check_decimal_range": check_decimal_range,
    "load_append_once": load_append_once,
    "load_append_keyed": load_append_keyed,
    "max_customer_id": max_customer_id,
    "sales_with_odd_prices": sales_with_odd_prices,
    "category_revenue_odd_prices": category_revenue_odd_prices,
    "daily_revenue_as_text": daily_revenue_as_text,
    "scan_catalogue_sheets": scan_catalogue_sheets,
    "check_primary_key_all": check_primary_key_all,
    "check_foreign_key_all": check_foreign_key_all,
    "check_foreign_key_batch": check_foreign_key_batch,
    "check_not_null_all": check_not_null_all,
    "check_length_all": check_length_all,
    "check_decimal_range_all": check_decimal_range_all,
}
