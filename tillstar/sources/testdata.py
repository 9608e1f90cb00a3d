"""The eight raw source tables, derived from the driver's test tables (FIXTURES.md §2).

The reference reads eight source files that are not part of its snapshot. For tests and
benchmarks the same raw tables are derived, with Spark, from the TPC-H-like parquet tables:
all of each table, no sampling. ``RAW_SQL`` holds the same mapping as DuckDB SQL for the oracle.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions.keys import dense_rank_ids
from tillstar.operators.dedup import keep_last
from tillstar.sources import files
from tillstar.sources.spec import SourceSpec

# Version columns of the order item mapping: l_shipdate, l_partkey, l_suppkey order the
# duplicates of one (l_orderkey, l_linenumber) totally.
ITEM_VERSION = ("_v_shipdate", "_v_partkey", "_v_suppkey")


class SourceTables:
    """Lazy raw tables over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._scans: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """The test table ``name`` (footer read once per instance)."""
        if name not in self._scans:
            self._scans[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._scans[name]

    # -- order_items (avro source): lineitem, keep-last per id by version
    @cached_property
    def order_item_versions(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("id"),
            F.col("l_orderkey").cast("bigint").alias("order_id"),
            F.col("l_partkey").cast("bigint").alias("product_id"),
            F.col("l_quantity").cast("bigint").alias("amount"),
            F.when(F.col("l_discount") > 0, F.round(F.col("l_discount") * 100).cast("bigint")).alias("coupon_id"),
            F.col("l_shipdate").alias("_v_shipdate"),
            F.col("l_partkey").alias("_v_partkey"),
            F.col("l_suppkey").alias("_v_suppkey"),
        )

    @cached_property
    def order_items(self) -> DataFrame:
        return keep_last(self.order_item_versions, ["id"], ITEM_VERSION).drop(*ITEM_VERSION)

    # -- coupons (column-oriented json): one coupon per discount level in lineitem
    @cached_property
    def coupons(self) -> DataFrame:
        li = self.table("lineitem")
        ids = (li.where(F.col("l_discount") > 0)
               .select(F.round(F.col("l_discount") * 100).cast("bigint").alias("id")).distinct())
        return ids.select("id", (F.col("id") * 10).cast("double").alias("discount_percent"))

    # -- orders (parquet)
    @cached_property
    def orders(self) -> DataFrame:
        o = self.table("orders")
        return o.select(F.col("o_orderkey").cast("bigint").alias("id"),
                        F.col("o_custkey").cast("string").alias("customer_id"),
                        F.col("o_orderstatus").alias("status"),
                        F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"))

    # -- product catalogue (sheets)
    @cached_property
    def _category_ids(self) -> DataFrame:
        """(p_type, id). Joined back to parts with a plain join: the planner broadcasts it when
        its estimate is small, and AQE switches to broadcast once it measures it otherwise."""
        return dense_rank_ids(self.table("part"), "p_type", "id")

    @cached_property
    def product_categories(self) -> DataFrame:
        return self._category_ids.select("id", F.col("p_type").alias("name"))

    @cached_property
    def products(self) -> DataFrame:
        part = self.table("part")
        n_suppliers = self.table("supplier").select(F.count(F.lit(1))).scalar()
        cats = self._category_ids.select("p_type", F.col("id").alias("category_id"))
        return (part.join(cats, "p_type", "left")
                .select(F.col("p_partkey").cast("bigint").alias("id"),
                        F.col("p_name").alias("name"),
                        F.col("p_retailprice").cast("double").alias("price"),
                        F.col("category_id"),
                        (F.col("p_partkey") % n_suppliers).cast("bigint").alias("supplier_id")))

    @cached_property
    def suppliers(self) -> DataFrame:
        s = self.table("supplier")
        n = self.table("nation").select("n_nationkey", "n_name")
        return (s.join(n, s.s_nationkey == n.n_nationkey, "left")
                .select(F.col("s_suppkey").cast("bigint").alias("id"),
                        F.col("s_name").alias("name"),
                        F.col("n_name").alias("country")))

    # -- customers (csv)
    @cached_property
    def customer(self) -> DataFrame:
        c = self.table("customer")
        return c.select(
            F.col("c_custkey").cast("bigint").alias("id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.when(F.col("c_custkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
            F.col("c_mktsegment").alias("address"),
            F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("zip_code"),
        )

    # -- login attempts (json)
    @cached_property
    def login_attemps(self) -> DataFrame:
        e = self.table("events")
        return e.select(F.col("event_id").cast("bigint").alias("id"),
                        F.col("user_id").cast("bigint").alias("customer_id"),
                        (F.col("event_type") != F.lit("error")).alias("login_successful"),
                        F.col("ts").cast("timestamp_ntz").alias("attempted_at"))

    def raw(self) -> "RawTables":
        return RawTables(self)


RAW_NAMES = ("coupons", "customer", "login_attemps", "order_items", "orders", "product_categories", "products",
             "suppliers")


class RawTables(dict):
    """Mapping name -> raw DataFrame that builds each table on first access only."""

    def __init__(self, tables: SourceTables):
        super().__init__()
        self._tables = tables

    def __missing__(self, name: str) -> DataFrame:
        if name not in RAW_NAMES:
            raise KeyError(name)
        df = getattr(self._tables, name)
        self[name] = df
        return df


# The same mapping in DuckDB SQL, as CTE bodies (used by the oracle queries).
RAW_SQL = {
    "order_item_versions": """
        SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS id, CAST(l_orderkey AS BIGINT) AS order_id,
               CAST(l_partkey AS BIGINT) AS product_id, CAST(l_quantity AS BIGINT) AS amount,
               CASE WHEN l_discount > 0 THEN CAST(round(l_discount * 100) AS BIGINT) END AS coupon_id,
               l_shipdate AS _v_shipdate, l_partkey AS _v_partkey, l_suppkey AS _v_suppkey
        FROM lineitem""",
    "order_items": """
        SELECT id, order_id, product_id, amount, coupon_id FROM (
          SELECT *, row_number() OVER (PARTITION BY id ORDER BY _v_shipdate DESC, _v_partkey DESC, _v_suppkey DESC) AS rn
          FROM raw_order_item_versions) WHERE rn = 1""",
    "coupons": """
        SELECT id, CAST(id * 10 AS DOUBLE) AS discount_percent FROM (
          SELECT DISTINCT CAST(round(l_discount * 100) AS BIGINT) AS id FROM lineitem WHERE l_discount > 0)""",
    "orders": """
        SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(o_custkey AS VARCHAR) AS customer_id,
               o_orderstatus AS status, CAST(o_orderdate AS TIMESTAMP) AS created_at FROM orders""",
    "product_categories": """
        SELECT CAST(dense_rank() OVER (ORDER BY p_type) AS BIGINT) AS id, p_type AS name
        FROM (SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL)""",
    "products": """
        SELECT CAST(p.p_partkey AS BIGINT) AS id, p.p_name AS name, CAST(p.p_retailprice AS DOUBLE) AS price,
               pc.id AS category_id, CAST(p.p_partkey % (SELECT count(*) FROM supplier) AS BIGINT) AS supplier_id
        FROM part p LEFT JOIN raw_product_categories pc ON pc.name = p.p_type""",
    "suppliers": """
        SELECT CAST(s.s_suppkey AS BIGINT) AS id, s.s_name AS name, n.n_name AS country
        FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "customer": """
        SELECT CAST(c_custkey AS BIGINT) AS id, split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               c_mktsegment AS address, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip_code
        FROM customer""",
    "login_attemps": """
        SELECT CAST(event_id AS BIGINT) AS id, CAST(user_id AS BIGINT) AS customer_id,
               event_type <> 'error' AS login_successful, CAST(ts AS TIMESTAMP) AS attempted_at
        FROM events""",
}

# CTE order: a body may only use names defined before it. Each CTE is named "raw_<key>".
RAW_CTE_ORDER = ("order_item_versions", "order_items", "coupons", "orders", "product_categories", "products",
                 "suppliers", "customer", "login_attemps")


def write_source_files(spark: SparkSession, sf_dir: str, root: str) -> list[SourceSpec]:
    """Lay the raw sources out as the ingest job finds them, derived from one test scale:
    customers as 10 CSV files, login attempts as 10 JSON-lines files, coupons as column-oriented
    JSON, order items as two parquet sets (older versions, then the latest version of each id),
    orders as parquet, the catalogue as CSV exports. Returns the source list in read order."""
    import glob

    from pyspark.sql import Window

    t = SourceTables(spark, sf_dir)
    v = t.order_item_versions.withColumn(
        "_rn", F.row_number().over(Window.partitionBy("id").orderBy(*[F.col(c).desc() for c in ITEM_VERSION])))
    cols = ["id", "order_id", "product_id", "amount", "coupon_id"]
    v.where("_rn > 1").select(*cols).write.parquet(f"{root}/items_old")
    v.where("_rn = 1").select(*cols).write.parquet(f"{root}/items_new")
    files.write_csv(t.customer, f"{root}/customer", 10)
    files.write_json_records(t.login_attemps, f"{root}/logins", 10)
    files.write_json_columns(t.coupons, f"{root}/coupons", 1)
    t.orders.write.parquet(f"{root}/orders")
    for name in ("product_categories", "products", "suppliers"):
        files.write_csv(getattr(t, name), f"{root}/{name}", 1)

    def ls(folder: str) -> tuple[str, ...]:
        return tuple(sorted(glob.glob(f"{root}/{folder}/part-*".replace("file:", ""))))
    return [SourceSpec("coupons", "json_columns", ls("coupons")), SourceSpec("customer", "csv", ls("customer")),
            SourceSpec("login_attemps", "json_records", ls("logins")),
            SourceSpec("order_items", "parquet", ls("items_old") + ls("items_new")),
            SourceSpec("orders", "parquet", ls("orders")),
            SourceSpec("product_categories", "csv", ls("product_categories")),
            SourceSpec("products", "csv", ls("products")), SourceSpec("suppliers", "csv", ls("suppliers"))]
