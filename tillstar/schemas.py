"""Schemas of the raw sources and of the model tables, with their declared constraints (K4).

Raw schemas are passed to the readers (no inference). Model specs drive the loader (column
types on write) and the quality checks (C1-C5). Keys are BIGINT throughout, also where the
alternative (ERD) model declares INT: at warehouse scale order and item ids pass 2^31.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


_TYPES = {"BIGINT": T.LongType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType(), "STRING": T.StringType(),
          "BOOLEAN": T.BooleanType(), "DATE": T.DateType(), "TIMESTAMP_NTZ": T.TimestampNTZType()}


def _s(columns: str) -> T.StructType:
    """``"a BIGINT, b STRING"`` -> StructType (flat columns of the types above; no session needed)."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(n, _TYPES[t.upper()]) for n, t in pairs])


# The raw tables' names and columns (the source system's spelling, "login_attemps"
# included), and below the model tables' names, columns, keys, NOT NULL columns and VARCHAR lengths
# as the warehouse DDL declares them.
RAW = {
    "coupons": _s("id BIGINT, discount_percent DOUBLE"),
    "customer": _s("id BIGINT, first_name STRING, last_name STRING, gender STRING, address STRING, zip_code STRING"),
    "login_attemps": _s("id BIGINT, customer_id BIGINT, login_successful BOOLEAN, attempted_at TIMESTAMP_NTZ"),
    "order_items": _s("id BIGINT, order_id BIGINT, product_id BIGINT, amount BIGINT, coupon_id BIGINT"),
    "orders": _s("id BIGINT, customer_id STRING, status STRING, created_at TIMESTAMP_NTZ"),
    "product_categories": _s("id BIGINT, name STRING"),
    "products": _s("id BIGINT, name STRING, price DOUBLE, category_id BIGINT, supplier_id BIGINT"),
    "suppliers": _s("id BIGINT, name STRING, country STRING"),
}


@dataclass(frozen=True)
class TableSpec:
    name: str                      # layer.table
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    foreign_keys: tuple[tuple[str, str, str], ...] = ()   # (column, parent table, parent column)
    not_null: tuple[str, ...] = ()
    max_length: dict = field(default_factory=dict)        # VARCHAR(n)
    decimal: dict = field(default_factory=dict)           # column -> (precision, scale)
    partition_by: tuple[str, ...] = ()


D = "dimensional"
P = "presentation"
E = "dbo"

STAR = [
    TableSpec(f"{D}.dim_coupons", _s("coupon_key BIGINT, discount_percent DOUBLE"), ("coupon_key",)),
    TableSpec(f"{D}.dim_date", _s("date_key BIGINT, date DATE, day_of_week INT, week INT, month INT, quarter INT, year INT"),
              ("date_key",), not_null=("date", "day_of_week", "week", "month", "quarter", "year")),
    TableSpec(f"{D}.dim_customers", _s("customers_key BIGINT, full_name STRING, first_name STRING, last_name STRING, "
                                      "gender STRING, address STRING, zip_code STRING"),
              ("customers_key",), max_length={"first_name": 150, "last_name": 150, "gender": 1, "zip_code": 8}),
    TableSpec(f"{D}.dim_login_attempts", _s("login_key BIGINT, customer_key BIGINT, login_successful BOOLEAN, attempted_at DATE"),
              ("login_key",), (("customer_key", f"{D}.dim_customers", "customers_key"),)),
    TableSpec(f"{D}.dim_product_categories", _s("product_categories_key BIGINT, name STRING"), ("product_categories_key",)),
    TableSpec(f"{D}.dim_suppliers", _s("suppliers_key BIGINT, name STRING, country STRING"), ("suppliers_key",),
              max_length={"name": 150, "country": 150}),
    TableSpec(f"{D}.dim_products", _s("products_key BIGINT, name STRING, price DOUBLE, product_categories_key BIGINT, suppliers_key BIGINT"),
              ("products_key",), (("product_categories_key", f"{D}.dim_product_categories", "product_categories_key"),
                                  ("suppliers_key", f"{D}.dim_suppliers", "suppliers_key"))),
    TableSpec(f"{D}.dim_orders", _s("order_key BIGINT, customers_key BIGINT, status STRING, created_at DATE"),
              ("order_key",), (("customers_key", f"{D}.dim_customers", "customers_key"),)),
    TableSpec(f"{D}.fact_sales_orders", _s("sale_order_key BIGINT, order_key BIGINT, customers_key BIGINT, product_key BIGINT, "
                                          "coupon_key BIGINT, date_key BIGINT, amount BIGINT, price_per_unit DOUBLE, total DOUBLE, "
                                          "discount DOUBLE, fixed_total DOUBLE, status STRING, created_at DATE"),
              ("sale_order_key",), (("order_key", f"{D}.dim_orders", "order_key"),
                                    ("customers_key", f"{D}.dim_customers", "customers_key"),
                                    ("product_key", f"{D}.dim_products", "products_key"),
                                    ("coupon_key", f"{D}.dim_coupons", "coupon_key"),
                                    ("date_key", f"{D}.dim_date", "date_key"))),
    TableSpec(f"{D}.fact_product_performance", _s("product_key BIGINT, name STRING, count_of_sales DOUBLE, total_revenue DOUBLE"),
              ("product_key",), (("product_key", f"{D}.dim_products", "products_key"),)),
    TableSpec(f"{D}.fact_product_category_performance", _s("category_key BIGINT, name STRING, count_of_sales DOUBLE, total_revenue DOUBLE"),
              ("category_key",), (("category_key", f"{D}.dim_product_categories", "product_categories_key"),)),
    TableSpec(f"{P}.daily_order_revenue_per_product", _s("date DATE, product_name STRING, category STRING, suppliers STRING, "
                                                        "amount BIGINT, revenue DOUBLE"), partition_by=("date",)),
    TableSpec(f"{P}.daily_order_revenue", _s("date DATE, amount BIGINT, revenue DOUBLE"), ("date",)),
    TableSpec(f"{P}.daily_order_revenue_per_categories", _s("date DATE, category STRING, amount BIGINT, revenue DOUBLE"),
              partition_by=("date",)),
    TableSpec(f"{P}.daily_order_revenue_per_suppliers", _s("date DATE, supplier_name STRING, country STRING, amount BIGINT, revenue DOUBLE"),
              partition_by=("date",)),
]

ERD = [
    TableSpec(f"{E}.dim_customers", _s("customers_key BIGINT, first_name STRING, last_name STRING, gender STRING, address STRING, zip_code STRING"),
              ("customers_key",), not_null=("first_name", "last_name", "gender", "address", "zip_code")),
    TableSpec(f"{E}.dim_login_attempts", _s("login_attempts_key BIGINT, customer_id BIGINT, login_successfull BOOLEAN, attempted_at TIMESTAMP_NTZ"),
              ("login_attempts_key",), not_null=("customer_id", "login_successfull", "attempted_at")),
    TableSpec(f"{E}.dim_product", _s("product_key BIGINT, name STRING, price DOUBLE, category_id BIGINT, supplier_id BIGINT"),
              ("product_key",), not_null=("name", "price", "category_id", "supplier_id"), max_length={"name": 6072}),
    TableSpec(f"{E}.dim_product_categories", _s("product_categories_key BIGINT, name STRING"), ("product_categories_key",),
              not_null=("name",)),
    TableSpec(f"{E}.dim_suppliers", _s("suppliers_key BIGINT, name STRING, country STRING"), ("suppliers_key",),
              not_null=("name", "country")),
    TableSpec(f"{E}.dim_orders", _s("orders_key BIGINT, customer_id STRING, status STRING, created_at TIMESTAMP_NTZ"),
              ("orders_key",), not_null=("customer_id", "status", "created_at")),
    TableSpec(f"{E}.dim_order_items", _s("order_items_key BIGINT, order_id BIGINT, product_id BIGINT, amount BIGINT, coupon_id BIGINT"),
              ("order_items_key",), not_null=("order_id", "product_id", "amount")),
    TableSpec(f"{E}.dim_coupons", _s("coupons_key BIGINT, discount_percent DOUBLE"), ("coupons_key",), not_null=("discount_percent",)),
    TableSpec(f"{E}.dim_date", _s("date_key BIGINT, date DATE, day_of_week INT, week INT, month INT, quarter INT, year INT"),
              ("date_key",), not_null=("date", "day_of_week", "week", "month", "quarter", "year")),
    TableSpec(f"{E}.fact_sale_orders", _s("order_key BIGINT, date_key BIGINT, product_key BIGINT, order_items_key BIGINT, "
                                         "sale_amount DOUBLE, status_order STRING"),
              # re-aimed to item grain: orders without items keep a NULL item key, so no PK is declared
              (), decimal={"sale_amount": (10, 2)}),
    TableSpec(f"{E}.fact_categories_performance", _s("category_performance_key BIGINT, product_categories_name STRING, total_revenue DOUBLE"),
              ("category_performance_key",), not_null=("product_categories_name", "total_revenue"),
              decimal={"total_revenue": (10, 2)}),
    TableSpec(f"{E}.fact_customer_activity", _s("customer_activity_key BIGINT, customers_key BIGINT, login_successful BOOLEAN, "
                                               "attempted_at TIMESTAMP_NTZ"), ("customer_activity_key",)),
]

SPECS = {s.name: s for s in STAR + ERD}


def declared_keys() -> list[tuple[str, str]]:
    """(table, key) of all 24 declared primary keys. The dbo sales fact declares its order key, although it holds a
    row for each item: the check reports that."""
    return [(s.name, s.primary_key[0]) if s.primary_key else (s.name, "order_key") for s in STAR + ERD if s.primary_key or s.name == f"{E}.fact_sale_orders"]


_DDL = {T.LongType: "BIGINT", T.IntegerType: "INT", T.DoubleType: "DOUBLE", T.StringType: "STRING", T.BooleanType: "BOOLEAN", T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP_NTZ"}


def ddl(spec: TableSpec) -> str:
    """The column list of the declared table: VARCHAR(n), DECIMAL(p,s) and NOT NULL as the DDL has them."""
    out = []
    for f in spec.schema.fields:
        kind = f"VARCHAR({spec.max_length[f.name]})" if f.name in spec.max_length else _DDL[type(f.dataType)]
        if f.name in spec.decimal:
            kind = "DECIMAL({}, {})".format(*spec.decimal[f.name])
        out.append(f"{f.name} {kind}" + (" NOT NULL" if f.name in spec.not_null or f.name in spec.primary_key else ""))
    return ", ".join(out)
