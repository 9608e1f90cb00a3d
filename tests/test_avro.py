"""The Avro data source: splits, codecs, schema resolution, round trips and writes that fail."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar import schemas
from tillstar.sources import avro, files
from tillstar.sources.avro import SYNC, compress, read_header, write_long


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture()
def items(spark):
    return spark.range(20_000).select(
        F.col("id"), (F.col("id") * 7 - 50_000).alias("order_id"), (F.col("id") % 97).alias("product_id"), F.lit(3).cast("long").alias("amount"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 10).alias("coupon_id"))


@pytest.mark.parametrize("codec", avro.CODECS)
def test_round_trip_by_several_tasks_a_file(spark, scratch, items, codec):
    files.write_avro(items, f"{scratch}/items", 2, codec, block_bytes=2_000)
    back = files.read_avro(spark, f"{scratch}/items", schemas.RAW["order_items"], split_bytes=10_000)
    assert rows_of(back) == rows_of(items)
    assert len(avro.list_files([f"{scratch}/items"])) == 2
    assert back.rdd.getNumPartitions() > 6


def test_any_split_size_reads_every_block_once(spark, scratch, items):
    few = items.limit(400)
    files.write_avro(few, f"{scratch}/items", 1, "null", block_bytes=100)
    for split in (17, 64, 333, 1 << 20):
        assert files.read_avro(spark, f"{scratch}/items", split_bytes=split).count() == 400


def test_every_type_survives(spark, scratch):
    schema = T.StructType.fromDDL(
        "b boolean, i int, l long, f float, d double, s string, y binary, day date, at timestamp_ntz, utc timestamp, m decimal(12,3), "
        "a array<long>, r struct<x: int, y: struct<z: string>>, k map<string, double>")
    row = (True, -5, 1 << 62, 0.5, 0.1, "ünd", b"\x00\xff", dt.date(1969, 12, 31), dt.datetime(1950, 1, 2, 3, 4, 5, 678901), dt.datetime(2024, 1, 1, 12, 0),
           Decimal("-123.456"), [1, None, -3], (4, ("deep",)), {"one": 1.0, "none": None})
    df = spark.createDataFrame([row, (None,) * 14, row], schema)
    files.write_avro(df, f"{scratch}/all", 1)
    back = files.read_avro(spark, f"{scratch}/all")
    assert {f.name: f.dataType for f in back.schema} == {f.name: f.dataType for f in schema}
    assert rows_of(back) == rows_of(df)


def test_schema_resolution(spark, scratch):
    files.write_avro(spark.createDataFrame([(1, "a", 2)], "id int, name string, n int"), f"{scratch}/x", 1)
    assert rows_of(files.read_avro(spark, f"{scratch}/x", T.StructType.fromDDL("n double, missing string, id long"))) == [(2.0, None, 1)]
    with pytest.raises(Exception, match="asked for"):
        files.read_avro(spark, f"{scratch}/x", T.StructType.fromDDL("name long")).collect()


def test_file_of_another_writer(spark, tmp_path):
    """A hand-made file: union with null last, named types used again, enum, fixed, millis, negative block counts."""
    kind = {"type": "record", "name": "R", "namespace": "n", "fields": [
        {"name": "u", "type": ["long", "null"]}, {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["x", "y"]}},
        {"name": "e2", "type": "n.E"}, {"name": "skip", "type": {"type": "map", "values": "string"}}, {"name": "f", "type": {"type": "fixed", "name": "F", "size": 2}},
        {"name": "t", "type": {"type": "long", "logicalType": "timestamp-millis"}}, {"name": "a", "type": {"type": "array", "items": "int"}}]}
    entry = write_long(1) + b"k" + write_long(2) + b"vv"
    row = write_long(0) + write_long(77) + write_long(1) + write_long(0) + write_long(-1) + write_long(len(entry)) + entry + b"\x00" + b"ab" + write_long(1500) + write_long(2) + write_long(5) + write_long(-6) + b"\x00"
    sync = bytes(range(SYNC))
    meta = json.dumps(kind).encode()
    head = avro.MAGIC + write_long(1) + write_long(11) + b"avro.schema" + write_long(len(meta)) + meta + b"\x00" + sync
    body = compress("null", row * 3)
    (tmp_path / "x.avro").write_bytes(head + write_long(3) + write_long(len(body)) + body + sync)
    got = files.read_avro(spark, str(tmp_path / "x.avro")).select("u", "e", "e2", "f", "a", F.unix_millis("t")).collect()
    assert [tuple(r) for r in got] == [(77, "y", "x", bytearray(b"ab"), [5, -6], 1500)] * 3
    assert files.read_avro(spark, str(tmp_path / "x.avro"), T.StructType.fromDDL("a array<int>")).collect()[0][0] == [5, -6]


def test_long_header_is_read_whole(tmp_path):
    names = [{"name": f"column_{i:06d}", "type": "long"} for i in range(5000)]
    meta = json.dumps({"type": "record", "name": "R", "fields": names}).encode()
    head = avro.MAGIC + write_long(1) + write_long(11) + b"avro.schema" + write_long(len(meta)) + meta + b"\x00" + b"s" * SYNC
    (tmp_path / "h.avro").write_bytes(head)
    with open(tmp_path / "h.avro", "rb") as f:
        assert read_header(f).end == len(head)


def test_positions_and_keep_last_over_files(spark, scratch):
    from tillstar.sources.spec import SourceSpec, read_source
    from tillstar.operators.clean import clean
    old = spark.createDataFrame([(1, 1, 1, 1, None), (2, 2, 2, 2, 2)], schemas.RAW["order_items"])
    files.write_avro(old, f"{scratch}/b", 1)
    files.write_avro(old.where("id = 1").withColumn("amount", F.lit(9).cast("long")), f"{scratch}/a", 1)
    spec = SourceSpec("order_items", "avro", (f"{scratch}/b", f"{scratch}/a"))
    assert rows_of(clean("order_items", read_source(spark, spec))) == [(1, 1, 1, 9, None), (2, 2, 2, 2, 2)]


def test_broken_and_empty_inputs(spark, scratch, tmp_path):
    (tmp_path / "bad.avro").write_bytes(b"nothing of the kind")
    with pytest.raises(Exception, match="not an Avro"):
        files.read_avro(spark, str(tmp_path / "bad.avro")).collect()
    with pytest.raises(Exception, match="(?i)not.?found"):
        files.read_avro(spark, f"{scratch}/absent", schemas.RAW["orders"]).collect()
    none = spark.createDataFrame([], schemas.RAW["orders"])
    files.write_avro(none, f"{scratch}/none", 2)
    assert files.read_avro(spark, f"{scratch}/none", schemas.RAW["orders"]).collect() == []


def test_failed_write_leaves_the_old_files(spark, scratch, items):
    files.write_avro(items.limit(5), f"{scratch}/t", 1)
    bad = items.withColumn("amount", F.when(F.col("id") == 19_999, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("amount")))
    with pytest.raises(Exception, match="stop"):
        files.write_avro(bad, f"{scratch}/t", 3)
    assert files.read_avro(spark, f"{scratch}/t").count() == 5
