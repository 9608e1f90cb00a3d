"""Cleaning of the raw sources (P1, P2, P6, P7 and NaN -> NULL), one rule per source.

The rules are the ingest job's transform step: cast, drop the unnamed index column (the
readers never return it), keep the last row per id for seven of the eight sources; orders
pass through with only their timestamp cast. A missing value stays NULL (never the text
'nan'), and a floating NaN becomes NULL.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.operators.dedup import keep_last
from tillstar.schemas import RAW
from tillstar.sources.files import READ_ORDER


@dataclass(frozen=True)
class CleanRule:
    casts: dict = field(default_factory=dict)
    dedup_keys: tuple[str, ...] = ("id",)


RULES = {
    "coupons": CleanRule({"discount_percent": "double"}),
    "customer": CleanRule({"zip_code": "string"}),
    "login_attemps": CleanRule(),
    "order_items": CleanRule(),
    "orders": CleanRule({"created_at": "timestamp_ntz"}, dedup_keys=()),
    "product_categories": CleanRule(),
    "products": CleanRule({"name": "string", "price": "double"}),
    "suppliers": CleanRule(),
}


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating NaN -> NULL in every float/double column."""
    return df.select(*[
        F.when(F.isnan(F.col(f.name)), F.lit(None)).otherwise(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields])


def clean(name: str, df: DataFrame) -> DataFrame:
    """Apply the rule of source ``name``; returns exactly the raw schema's columns.

    ``df`` should carry the read position (``READ_ORDER`` columns) when the rule
    de-duplicates; without it the last row per id is not defined and an error is raised."""
    rule = RULES[name]
    out = df
    for c, t in rule.casts.items():
        out = out.withColumn(c, F.col(c).cast(t))
    out = nan_to_null(out)
    if rule.dedup_keys:
        missing = [c for c in READ_ORDER if c not in out.columns]
        if missing:
            raise ValueError(f"{name}: keep-last needs the read position columns, missing {missing}")
        out = keep_last(out, rule.dedup_keys)
    schema = RAW[name]
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
