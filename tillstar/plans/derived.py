"""Sums and marts derived from the stored sales fact, brought forward by version.

Two tables of exact sums stand between the fact and everything else: sales by (day, product) and by product. Each
knows which version of the fact it takes account of. What later versions of the fact took out and put in
(``versions.changes``: the fact's own upsert keeps old and new values side by side) is summed with its sign and added
to the months or product ranges it touches. Each mart in turn knows the version of the sums and of the dimensions
it shows, and rewrites the months in which something changed: sales, or the name, category or supplier of a product sold.

So a lost run is caught up by the next one, each change exactly once, and a run without changes
rewrites nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.functions.money import LINE
from tillstar.operators import load, versions
from tillstar.operators.versions import Layout
from tillstar.plans import facts, marts
from tillstar.session import reliable_checkpoint

SALE_COLUMNS = ("date_key", "product_key", "amount", "fixed_total")
MONTHS = Layout(("year", "month"))
PRODUCT_RANGE_WIDTH = 1 << 20
PRODUCTS = Layout(("product_range",), ("product_key",), 16)
PERFORMANCE = Layout(("product_range",), hidden=("product_range",))
BY_DAY, BY_PRODUCT = "sales_by_day_product", "sales_by_product"
SUMS = ("n", "n_amount", "n_revenue", "amount", "revenue")


def product_range(key: str) -> Column:
    return F.floor(F.col(key) / F.lit(PRODUCT_RANGE_WIDTH)).cast("bigint").alias("product_range")


def month_of(date_key: str) -> list[Column]:
    day = F.col(date_key)
    return [F.call_function("div", day, F.lit(10_000)).cast("int").alias("year"), (F.call_function("div", day, F.lit(100)) % 100).cast("int").alias("month")]


def signed_sums(lines: DataFrame, *keys: str) -> DataFrame:
    """Sums of sales lines with a ``sign``. Counts of lines, amounts and revenues tell when a sum is empty or NULL."""
    sign = F.col("sign").cast("long")
    money = F.col("fixed_total").cast(LINE)
    return lines.groupBy(*keys).agg(
        F.sum(sign).alias("n"), F.sum(F.when(F.col("amount").isNotNull(), sign).otherwise(0)).alias("n_amount"),
        F.sum(F.when(money.isNotNull(), sign).otherwise(0)).alias("n_revenue"),
        F.coalesce(F.sum(sign * F.col("amount")), F.lit(0)).alias("amount"),
        F.coalesce(F.sum(F.when(F.col("sign") > 0, money).otherwise(-money)), F.lit(0)).cast("decimal(38,16)").alias("revenue"))


def _nothing_changed() -> Column:
    zero = F.lit(True)
    for c in SUMS:
        zero = zero & (F.col(c) == 0)
    return zero


def _add(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Old sums plus signed ones; groups that no line is left of go."""
    t, s = target.alias("t"), delta.alias("s")
    # a single key is never NULL, and a plain equality keeps the buckets of the target
    same = [F.col(f"t.{k}") == F.col(f"s.{k}") if len(keys) == 1 else F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    j = t.join(s, same, "full_outer")
    rest = [c for c in target.columns if c not in SUMS]
    out = j.select(*[F.coalesce(f"t.{c}", f"s.{c}").alias(c) for c in rest],
                   *[(F.coalesce(f"t.{c}", F.lit(0)) + F.coalesce(f"s.{c}", F.lit(0))).cast(target.schema[c].dataType).alias(c) for c in SUMS])
    return out.where("n > 0").select(*target.columns)


def _refresh_sums(spark: SparkSession, table: str, fact: str, keys: list[str], where: str, place: list[Column], layout: Layout) -> None:
    now = versions.current(spark, fact)
    seen = versions.followed(spark, table).get("fact")
    if seen == now:
        return
    told = seen is not None and versions.fresh(spark, fact, seen)[1]
    if not told:
        lines = spark.table(fact).where(where).select(*SALE_COLUMNS, F.lit(1).alias("sign"))
        versions.replace(spark, table, signed_sums(lines, *keys).select(*keys, *SUMS, *place), layout, follows={"fact": now})
        return
    lines = versions.changes(spark, fact, seen, SALE_COLUMNS, SALE_COLUMNS).where(where)
    delta = reliable_checkpoint(signed_sums(lines, *keys).where(~_nothing_changed()).select(*keys, *SUMS, *place))
    versions.rewrite(spark, table, delta, lambda target: _add(target, delta, keys), layout, follows={"fact": now})


def _exposed(sums: DataFrame) -> DataFrame:
    """Sums as SQL gives them: NULL where every value was NULL. (Column names of ``plans.marts``.)"""
    return (sums.withColumn("amount", F.when(F.col("n_amount") > 0, F.col("amount")))
            .withColumn("revenue_dec", F.when(F.col("n_revenue") > 0, F.col("revenue"))).drop("n", "n_amount", "n_revenue", "revenue"))


def _changed_products(spark: SparkSession, dim_db: str, seen: dict[str, int]) -> DataFrame | None:
    """Keys of products that look different in a mart since the versions ``seen``; None if that is not known."""
    products = spark.table(f"{dim_db}.dim_products")
    found = []
    for name, key, columns, fk in (("dim_products", "products_key", ("name", "product_categories_key", "suppliers_key"), None),
                                   ("dim_product_categories", "product_categories_key", ("name",), "product_categories_key"),
                                   ("dim_suppliers", "suppliers_key", ("name", "country"), "suppliers_key")):
        table = f"{dim_db}.{name}"
        if seen.get(name) == versions.current(spark, table):
            continue
        if name not in seen or not versions.fresh(spark, table, seen[name])[1]:
            return None
        keys = versions.changed_keys(spark, table, seen[name], [key], columns)
        found.append(keys if fk is None else products.join(keys, fk, "left_semi").select("products_key"))
    out = spark.createDataFrame([], "products_key bigint")
    for f in found:
        out = out.unionAll(f.toDF("products_key"))
    return out.distinct()


def _versions(spark: SparkSession, dim_db: str, pres_db: str) -> dict[str, int]:
    return {name: versions.current(spark, f"{db}.{name}") for db, name in (
        (pres_db, BY_DAY), (pres_db, BY_PRODUCT), (dim_db, "dim_products"), (dim_db, "dim_product_categories"), (dim_db, "dim_suppliers"))}


def _touched_months(spark: SparkSession, table: str, dim_db: str, pres_db: str) -> DataFrame | None:
    """(year, month) to rewrite in a mart; None: all."""
    seen, by_day = versions.followed(spark, table), f"{pres_db}.{BY_DAY}"
    if BY_DAY not in seen:
        return None
    specs, _ = versions.fresh(spark, by_day, seen[BY_DAY])
    products = _changed_products(spark, dim_db, seen)
    if specs is None or products is None:
        return None
    schema = versions.read(spark, by_day).schema
    months = versions.specs_frame(spark, specs, MONTHS, schema)
    sold = spark.table(by_day).join(products, F.col("product_key") == F.col("products_key"), "left_semi").select("year", "month")
    return reliable_checkpoint(months.unionByName(sold.distinct()).distinct())


def _refresh_marts(spark: SparkSession, dim_db: str, pres_db: str, append: bool) -> None:
    follows = _versions(spark, dim_db, pres_db)
    d = {n: spark.table(f"{dim_db}.{n}").drop("key_range") for n in ("dim_date", "dim_products", "dim_suppliers", "dim_product_categories")}
    build = {
        "daily_order_revenue_per_product": lambda sales: marts.revenue_by_day_product(sales, d["dim_suppliers"], d["dim_product_categories"]),
        "daily_order_revenue_per_categories": lambda sales: marts.revenue_by_day_category(sales, d["dim_product_categories"]),
        "daily_order_revenue_per_suppliers": lambda sales: marts.revenue_by_day_supplier(sales, d["dim_suppliers"]),
        "daily_order_revenue": marts.revenue_by_day,
    }
    todo = {}
    for name in build:
        table = f"{pres_db}.{name}"
        keyed = bool(schemas.SPECS[f"{schemas.P}.{name}"].primary_key)
        if (append and not keyed) or versions.followed(spark, table) != follows:
            todo[name] = None if append and not keyed else _touched_months(spark, table, dim_db, pres_db)
    if not todo:
        return
    # one pass joins products and days for all marts: the union of their months
    base = spark.table(f"{pres_db}.{BY_DAY}")
    if all(m is not None for m in todo.values()):
        months = None
        for m in todo.values():
            months = m if months is None else months.unionByName(m)
        rows = months.distinct().collect()     # one row a month
        base = base.where(versions.any_of(("year", "month"), rows)) if rows else base.limit(0)
    sales = reliable_checkpoint(marts.with_products(_exposed(base).drop("year", "month"), d["dim_date"], d["dim_products"]))
    for name, months in todo.items():
        table, spec = f"{pres_db}.{name}", f"{schemas.P}.{name}"
        of_months = sales if months is None else sales.join(months, [F.year("date") == F.col("year"), F.month("date") == F.col("month")], "left_semi")
        rows = load.conform(build[name](of_months), spec).withColumn("year", F.year("date")).withColumn("month", F.month("date"))
        if schemas.SPECS[spec].primary_key:
            versions.upsert_versioned(spark, table, rows, ["date"], ["amount", "revenue"], MONTHS, whole=months is None, follows=follows)
        elif append and versions.current(spark, table):
            stored = rows
            versions.rewrite(spark, table, rows, lambda target, stored=stored: target.unionByName(stored), MONTHS, follows=follows)
        elif months is None:
            versions.replace(spark, table, rows, MONTHS, follows=follows)
        else:
            versions.replace_partitions(spark, table, rows, months, MONTHS, follows)


def _refresh_performance(spark: SparkSession, raw_db: str, dim_db: str, pres_db: str) -> None:
    """M2 for touched ranges of products, M3 whole (one row a category)."""
    by_product = f"{pres_db}.{BY_PRODUCT}"
    table = f"{dim_db}.fact_product_performance"
    seen, raw_products = versions.followed(spark, table), f"{raw_db}.products"
    follows = {BY_PRODUCT: versions.current(spark, by_product), "products": versions.current(spark, raw_products)}
    products = spark.table(raw_products).withColumn("product_range", product_range("id"))
    sums = spark.table(by_product)
    if seen != follows:
        specs = versions.fresh(spark, by_product, seen[BY_PRODUCT])[0] if BY_PRODUCT in seen else None
        names_stay = seen.get("products") == follows["products"]
        if specs is not None and names_stay:
            ranges = [int(s.split("=")[1]) for s in specs]
            products, part = products.where(F.col("product_range").isin(ranges)), sums.where(F.col("product_range").isin(ranges))
        else:
            part = sums
        rows = facts.performance_of(products.drop("product_range"), _exposed(part).drop("product_range"))
        rows = load.conform(rows, f"{schemas.D}.fact_product_performance").withColumn("product_range", product_range("product_key"))
        versions.upsert_versioned(spark, table, rows, ["product_key"], ["name", "count_of_sales", "total_revenue"], PERFORMANCE, whole=specs is None, follows=follows)
    table = f"{dim_db}.fact_product_category_performance"
    follows = {BY_PRODUCT: follows[BY_PRODUCT]} | {n: versions.current(spark, f"{dim_db}.{n}") for n in ("dim_products", "dim_product_categories")}
    if versions.followed(spark, table) != follows:
        rows = facts.category_performance_of(spark.table(f"{dim_db}.dim_product_categories"), spark.table(f"{dim_db}.dim_products"), _exposed(sums))
        versions.upsert_versioned(spark, table, load.conform(rows, f"{schemas.D}.fact_product_category_performance"), ["category_key"],
                                  ["name", "count_of_sales", "total_revenue"], follows=follows)


def refresh(spark: SparkSession, raw_db: str, dim_db: str, pres_db: str, append: bool = False) -> None:
    """Bring sums, performance facts and marts to the current version of the fact and the dimensions."""
    fact = f"{dim_db}.fact_sales_orders"
    _refresh_sums(spark, f"{pres_db}.{BY_DAY}", fact, ["date_key", "product_key"], "date_key is not null", month_of("date_key"), MONTHS)
    _refresh_sums(spark, f"{pres_db}.{BY_PRODUCT}", fact, ["product_key"], "product_key is not null", [product_range("product_key")], PRODUCTS)
    _refresh_performance(spark, raw_db, dim_db, pres_db)
    _refresh_marts(spark, dim_db, pres_db, append)


def attach(spark: SparkSession, dim_db: str, pres_db: str) -> None:
    """Enter the stored derived tables into a catalog that does not know them."""
    versions.attach(spark, f"{pres_db}.{BY_DAY}", MONTHS)
    versions.attach(spark, f"{pres_db}.{BY_PRODUCT}", PRODUCTS)
    versions.attach(spark, f"{dim_db}.fact_product_performance", PERFORMANCE)
    versions.attach(spark, f"{dim_db}.fact_product_category_performance", Layout())
    for name in ("daily_order_revenue_per_product", "daily_order_revenue_per_categories", "daily_order_revenue_per_suppliers", "daily_order_revenue"):
        versions.attach(spark, f"{pres_db}.{name}", MONTHS)
