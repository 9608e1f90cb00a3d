"""The warehouse job end to end: ingest -> raw tables -> star model -> marts (and the dbo model), whole or by batches.

Every stage reads the tables written by the stage before it, so lineage is cut at each table and a lost
executor costs at most the current stage. Every load makes a new version of its table and switches it in whole
(``operators.versions``); a retried or re-run job ends in the same tables.

``ingest`` + ``build_star`` take the full history. ``build_batch`` takes new and changed raw rows: it
upserts the raw tables and dimensions, recomputes the sales lines that the batch can have changed, and hands on to
``plans.derived`` which brings the sums and marts forward from the fact's own row changes.

Update columns of each upsert are the warehouse's ``ON CONFLICT DO UPDATE SET`` lists: three
dimensions deliberately keep a column of the first load (login customer, product supplier,
order customer).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.operators import keysets, load, quality, versions
from tillstar.operators.clean import clean
from tillstar.operators.versions import Layout
from tillstar.plans import derived, dims, erd, facts
from tillstar.session import reliable_checkpoint
from tillstar.sources.spec import SourceSpec, read_source

# The columns each upsert does NOT update on conflict (as the warehouse's
# ON CONFLICT DO UPDATE lists leave them out); every other non-key column is updated.
KEEP_ON_CONFLICT = {
    "dim_login_attempts": ("customer_key",),
    "dim_products": ("suppliers_key",),
    "dim_orders": ("customers_key",),
}

# The sales fact and the dimensions that grow with the data are stored in partitions of this many
# consecutive keys (column ``key_range``), so an upsert rewrites only the key ranges its batch touches; the
# largest are bucketed by their key inside each, so the merge does not shuffle them. Coupons, categories and
# days are bounded and merged as whole tables.
KEY_RANGE_WIDTH = 1 << 24
BUCKETS = 16
KEY_RANGED_DIMS = ("dim_customers", "dim_login_attempts", "dim_suppliers", "dim_products", "dim_orders")
BUCKETED = ("dim_login_attempts", "dim_orders", "fact_sales_orders")
RAW_LAYOUT = Layout(("key_range",), hidden=("key_range",))
# Columns whose changes the derived tables ask for.
REMEMBERED = {
    "dim_customers": ("zip_code",),             # none asks; so that the key set follows what was inserted
    "dim_products": ("name", "product_categories_key", "suppliers_key"),
    "dim_product_categories": ("name",),
    "dim_suppliers": ("name", "country"),
    "fact_sales_orders": derived.SALE_COLUMNS,
}


def with_key_range(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn("key_range", F.floor(F.col(key) / F.lit(KEY_RANGE_WIDTH)).cast("bigint"))


def layout_of(name: str) -> Layout:
    """How a table of the dimensional layer is stored."""
    if name not in KEY_RANGED_DIMS and name != "fact_sales_orders":
        return Layout()
    key = schemas.SPECS[f"{schemas.D}.{name}"].primary_key
    return Layout(("key_range",), key, BUCKETS) if name in BUCKETED else Layout(("key_range",))


def update_columns(table: str) -> list[str]:
    spec = schemas.SPECS[table]
    short = table.split(".", 1)[1]
    keep = set(spec.primary_key) | set(KEEP_ON_CONFLICT.get(short, ()))
    return [f.name for f in spec.schema.fields if f.name not in keep]


def raw_rows(name: str, df: DataFrame) -> DataFrame:
    """Raw rows with their key range; rows without an id, which only orders may hold, are kept in a range of their own."""
    return with_key_range(df, "id").withColumn("key_range", F.coalesce("key_range", F.lit(-1).cast("bigint")))


def ingest(spark: SparkSession, sources: Sequence[SourceSpec], raw_db: str, location: str | None = None) -> None:
    """Read every source, clean it, and replace its raw table (K1)."""
    load.create_layer(spark, raw_db, location)
    for spec in sources:
        versions.replace(spark, f"{raw_db}.{spec.name}", raw_rows(spec.name, clean(spec.name, read_source(spark, spec))), RAW_LAYOUT)


def _raw(spark: SparkSession, raw_db: str) -> dict[str, DataFrame]:
    return {n: spark.table(f"{raw_db}.{n}") for n in schemas.RAW}


def attach(spark: SparkSession, raw_db: str, dim_db: str = schemas.D, pres_db: str = schemas.P, locations: dict | None = None) -> None:
    """Enter all stored tables into a catalog that does not know them (a new session without a metastore)."""
    for db in (raw_db, dim_db, pres_db):
        load.create_layer(spark, db, (locations or {}).get(db))
    for name in schemas.RAW:
        versions.attach(spark, f"{raw_db}.{name}", RAW_LAYOUT)
    for name in (*dims.BUILDERS, "fact_sales_orders"):
        versions.attach(spark, f"{dim_db}.{name}", layout_of(name))
    derived.attach(spark, dim_db, pres_db)


def _check_foreign_keys(spark: SparkSession, built: dict[str, DataFrame], dim_db: str) -> None:
    """The dimensions' declared FOREIGN KEYs, before anything is written; a parent row may be in this load or
    already stored. The fact's hold by construction (each of its keys comes from a join with the parent)."""
    def parents(name: str, col: str) -> DataFrame:
        stored = f"{dim_db}.{name}"
        known = [built[name].select(col)] if name in built else []
        known += [spark.table(stored).select(col)] if spark.catalog.tableExists(stored) else []
        return reduce(DataFrame.unionByName, known)

    checks = [(f"{name}.{col}", built[name], col, parents(parent.split(".", 1)[1], pcol), pcol)
              for name in built for col, parent, pcol in schemas.SPECS[f"{schemas.D}.{name}"].foreign_keys]
    if checks:
        quality.enforce_foreign_keys(checks)


def _check_batch_keys(spark: SparkSession, built: dict[str, DataFrame], dim_db: str) -> None:
    """The same for a batch: its keys against the batch's own parents, and what is left against the bitmaps of the stored
    parents' keys. No parent table is read."""
    checks = []
    for name in built:
        for col, parent, pcol in schemas.SPECS[f"{schemas.D}.{name}"].foreign_keys:
            rows, parent = built[name].select(col), parent.split(".", 1)[1]
            if parent in built:
                rows = rows.join(built[parent].select(F.col(pcol).alias(col)), col, "left_anti")
            checks.append((f"{name}.{col}", rows, col, keysets.sync(spark, f"{dim_db}.{parent}", pcol)))
    bad = [r for r in keysets.orphans(spark, checks).collect() if r.orphan_rows] if checks else []
    if bad:
        raise ValueError("foreign key violation: " + ", ".join(f"{r.constraint_name}: {r.orphan_rows} rows / {r.orphan_keys} keys" for r in bad))


def _upsert(spark: SparkSession, db: str, name: str, df: DataFrame, whole: bool) -> None:
    table = f"{schemas.D}.{name}"
    layout = layout_of(name)
    rows = with_key_range(df, schemas.SPECS[table].primary_key[0]) if layout.partition_by else df
    versions.upsert_versioned(spark, f"{db}.{name}", rows, schemas.SPECS[table].primary_key, update_columns(table), layout,
                              REMEMBERED.get(name, ()), whole)


def build_star(spark: SparkSession, raw_db: str, dim_db: str = schemas.D, pres_db: str = schemas.P,
               locations: dict | None = None, marts_mode: str = "overwrite_partitions",
               check_foreign_keys: bool = True) -> None:
    """Dimensions, facts and marts of the star model from the raw tables.

    The raw tables hold the full history, as the warehouse's model assumes, so every key range is touched and the
    upserts merge against the whole target. Sums and marts are then brought forward by what changed in the fact, so
    those of untouched months stay as they are.

    ``marts_mode``: "overwrite_partitions" (re-run safe, default) or "append" (as the
    warehouse script, which duplicates rows of the three marts without a key on a re-run).
    ``check_foreign_keys``: fail, before any table is written, when a dimension's declared foreign
    key has orphans (the warehouse's DDL rejects such an insert)."""
    locations = locations or {}
    load.create_layer(spark, dim_db, locations.get(dim_db))
    load.create_layer(spark, pres_db, locations.get(pres_db))
    raw = _raw(spark, raw_db)

    built = {name: load.conform(build(raw), f"{schemas.D}.{name}") for name, build in dims.BUILDERS.items()}
    if check_foreign_keys:
        _check_foreign_keys(spark, built, dim_db)
    for name, df in built.items():
        _upsert(spark, dim_db, name, df, whole=True)
    d = {n: spark.table(f"{dim_db}.{n}").drop("key_range") for n in dims.BUILDERS}
    fact = facts.fact_sales_orders(raw["order_items"], d["dim_products"], d["dim_orders"], d["dim_customers"], d["dim_coupons"])
    _upsert(spark, dim_db, "fact_sales_orders", load.conform(fact, f"{schemas.D}.fact_sales_orders"), whole=True)
    derived.refresh(spark, raw_db, dim_db, pres_db, append=marts_mode == "append")


def _ranges(df: DataFrame, col: str) -> list[int]:
    """Key ranges of a column's values: at most one value a stored partition."""
    rows = df.select(F.floor(F.col(col) / F.lit(KEY_RANGE_WIDTH)).cast("bigint").alias("r")).where("r is not null").distinct().collect()
    return [r["r"] for r in rows]


def build_batch(spark: SparkSession, batch: dict[str, DataFrame], raw_db: str, dim_db: str = schemas.D, pres_db: str = schemas.P,
                check_foreign_keys: bool = True) -> None:
    """New and changed raw rows (cleaned, by source name), merged into a built warehouse.

    Ends in the tables that ``build_star`` over the merged raw tables gives. Only touched key ranges of
    raw tables, dimensions and fact, and touched months of sums and marts, are read and written; one case reads two
    columns of all raw order items: orders, products or coupons in the batch, whose items may be older. A batch that
    is run again, after a failure at any step, ends in the same tables: each step depends on
    the batch's keys and on stored versions only, not on what the lost run did."""
    attach(spark, raw_db, dim_db, pres_db)
    batch = {name: reliable_checkpoint(df) for name, df in batch.items()}
    raw_part = {name: batch.get(name, spark.createDataFrame([], schemas.RAW[name])) for name in schemas.RAW}
    # the login filter compares with the largest stored customer id, not with the batch's
    customers = spark.table(f"{raw_db}.customer").select("id").unionAll(raw_part["customer"].select("id"))
    sources = {"dim_coupons": "coupons", "dim_date": "orders", "dim_customers": "customer", "dim_product_categories": "product_categories",
               "dim_suppliers": "suppliers", "dim_products": "products", "dim_orders": "orders"}
    built = {name: dims.BUILDERS[name](raw_part) for name, source in sources.items() if source in batch}
    if "login_attemps" in batch or "customer" in batch:
        logins = raw_part["login_attemps"]
        if "customer" in batch:                 # a higher customer id lets in stored attempts that the strict filter left out
            largest = spark.table(f"{raw_db}.customer").select(F.max("id")).scalar()
            late = spark.table(f"{raw_db}.login_attemps").where(F.col("customer_id") >= largest)
            logins = logins.unionByName(late.join(logins.select("id"), "id", "left_anti"))
        built["dim_login_attempts"] = dims.dim_login_attempts(logins, customers)
    built = {name: load.conform(df, f"{schemas.D}.{name}") for name, df in built.items()}
    if check_foreign_keys:
        _check_batch_keys(spark, built, dim_db)
    for name, df in built.items():
        _upsert(spark, dim_db, name, df, whole=False)
    for name, df in batch.items():
        update = [f.name for f in schemas.RAW[name].fields if f.name != "id"]
        versions.upsert_versioned(spark, f"{raw_db}.{name}", raw_rows(name, df), ["id"], update, RAW_LAYOUT)

    items = reliable_checkpoint(affected_items(spark, batch, raw_db))
    d = {n: spark.table(f"{dim_db}.{n}") for n in dims.BUILDERS}
    orders = d["dim_orders"].where(F.col("key_range").isin(_ranges(items, "order_id")))
    known = orders.join(items.select(F.col("order_id").alias("order_key")).distinct(), "order_key", "left_semi")
    known = reliable_checkpoint(known.drop("key_range"))
    customers = d["dim_customers"].where(F.col("key_range").isin(_ranges(known, "customers_key")))
    products = d["dim_products"].where(F.col("key_range").isin(_ranges(items, "product_id")))
    fact = facts.fact_sales_orders(items, products, known, customers, d["dim_coupons"])
    _upsert(spark, dim_db, "fact_sales_orders", load.conform(fact, f"{schemas.D}.fact_sales_orders"), whole=False)
    derived.refresh(spark, raw_db, dim_db, pres_db)


def affected_items(spark: SparkSession, batch: dict[str, DataFrame], raw_db: str) -> DataFrame:
    """Order items whose sales line the batch can change: its own, and those of its orders, products and coupons."""
    items = spark.table(f"{raw_db}.order_items")
    by = {"orders": "order_id", "products": "product_id", "coupons": "coupon_id"}
    named = {name: col for name, col in by.items() if name in batch}
    own = batch.get("order_items", spark.createDataFrame([], schemas.RAW["order_items"]))
    if not named:
        return own
    hit = F.lit(False)
    for name, col in named.items():
        mark = f"_in_{name}"
        items = items.join(batch[name].select(F.col("id").alias(col), F.lit(True).alias(mark)).distinct(), col, "left")
        hit = hit | F.col(mark).isNotNull()
    old = items.where(hit).select(*own.columns).join(own.select("id"), "id", "left_anti").select(*own.columns)
    return own.unionByName(old)


def build_erd(spark: SparkSession, raw_db: str, erd_db: str = schemas.E, location: str | None = None, ranges: bool = True) -> None:
    """The dbo model: dimensions and facts replaced, so a re-run gives the same tables.

    Declared NOT NULL, VARCHAR(n) and DECIMAL(10,2) columns are enforced row by row, and the primary keys of all tables
    before any table of their layer is switched in (the re-aimed sales fact has none: it holds a row for each item).
    A category that sells for 100 million or more does not fit its DECIMAL(10,2), and the job fails as the statement
    would; without ``ranges`` such sums are stored."""
    load.create_layer(spark, erd_db, location)
    r = _raw(spark, raw_db)
    tables = {
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

    def store(made: dict[str, DataFrame]) -> None:
        made = {name: load.conform(df, f"{schemas.E}.{name}", ranges=ranges) for name, df in made.items()}
        keyed = [(n, df, schemas.SPECS[f"{schemas.E}.{n}"].primary_key) for n, df in made.items() if schemas.SPECS[f"{schemas.E}.{n}"].primary_key]
        quality.enforce_primary_keys(keyed)
        for name, df in made.items():
            versions.replace(spark, f"{erd_db}.{name}", df)

    store(tables)
    e = {n: spark.table(f"{erd_db}.{n}") for n in tables}
    store({"fact_sale_orders": erd.sale_lines(e["dim_orders"], e["dim_order_items"], e["dim_product"]),
           "fact_categories_performance": erd.category_revenue(e["dim_product_categories"], e["dim_product"], e["dim_order_items"]),
           "fact_customer_activity": erd.customer_activity(e["dim_login_attempts"])})


def quality_reports(spark: SparkSession, dim_db: str = schemas.D, pres_db: str = schemas.P,
                    quality_db: str = "quality", location: str | None = None) -> None:
    """C1-C4 over the stored star model, written as tables of ``quality_db``: primary_keys,
    foreign_keys, not_null, lengths (one row per checked table / constraint / column)."""
    load.create_layer(spark, quality_db, location)

    def stored(spec_name: str) -> DataFrame:
        layer, name = spec_name.split(".", 1)
        db = dim_db if layer == schemas.D else pres_db
        # the declared columns only (storage adds key_range, or year/month for the marts)
        return spark.table(f"{db}.{name}").select(*schemas.SPECS[spec_name].schema.fieldNames())

    specs = [s for s in schemas.STAR if spark.catalog.tableExists(
        f"{dim_db if s.name.startswith(schemas.D) else pres_db}.{s.name.split('.', 1)[1]}")]
    tables = {s.name: stored(s.name) for s in specs}
    reports = {
        "primary_keys": quality.primary_key_report([(s.name, tables[s.name], s.primary_key)
                                                    for s in specs if s.primary_key]),
        "foreign_keys": quality.foreign_key_report([
            (f"{s.name}.{col}", tables[s.name], col, tables[parent], pcol)
            for s in specs for col, parent, pcol in s.foreign_keys if parent in tables]),
        "not_null": quality.not_null_report([(s.name, tables[s.name], s.not_null) for s in specs if s.not_null]),
        "lengths": quality.length_report([(s.name, tables[s.name], s.max_length) for s in specs if s.max_length]),
    }
    for name, df in reports.items():
        load.replace(df, f"{quality_db}.{name}")
