import os

from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.operators.dedup import keep_last
from tillstar.sources import files


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_keep_last_over_files(spark, scratch):
    d = scratch.replace("file:", "")
    a = _write(os.path.join(d, "a.csv"), ",id,name\n0,1,old\n1,2,x\n")
    b = _write(os.path.join(d, "b.csv"), ",id,name\n0,1,new\n")
    schema = schemas._s("id BIGINT, name STRING")
    got = keep_last(files.read_csv(spark, [a, b], schema, positions=True), ["id"])
    assert sorted(map(tuple, got.collect())) == [(1, "new"), (2, "x")]
    # the list order decides, not file size or name: B (larger) before A
    big = _write(os.path.join(d, "z_big.csv"), ",id,name\n" + "".join(f"{i},{i + 10},y\n" for i in range(500))
                 + "0,1,big\n")
    got = keep_last(files.read_csv(spark, [big, a], schema, positions=True), ["id"])
    assert dict(map(tuple, got.collect()))[1] == "old"


def test_keep_last_within_file_keeps_last_line(spark, scratch):
    d = scratch.replace("file:", "")
    p = _write(os.path.join(d, "c.csv"), ",id,name\n" + "".join(f"{i},7,n{i}\n" for i in range(1000)))
    got = keep_last(files.read_csv(spark, [p], schemas._s("id BIGINT, name STRING"), positions=True), ["id"])
    assert [tuple(r) for r in got.collect()] == [(7, "n999")]


def test_csv_zip_code_stays_text(spark, scratch):
    d = scratch.replace("file:", "")
    p = _write(os.path.join(d, "cust.csv"),
               ",id,first_name,last_name,gender,address,zip_code\n0,1,A,B,F,x,00123\n1,2,C,D,M,y,\n")
    rows = files.read_csv(spark, [p], schemas.RAW["customer"]).orderBy("id").collect()
    assert rows[0].zip_code == "00123" and rows[1].zip_code is None
    assert "_index" not in files.read_csv(spark, [p], schemas.RAW["customer"]).columns


def test_column_json_labels(spark, scratch):
    d = scratch.replace("file:", "")
    p = _write(os.path.join(d, "coupons.json"),
               '{"id":{"10":3,"0":1,"5":2},"discount_percent":{"0":10,"10":30}}\n')
    rows = files.read_json_columns(spark, [p], schemas.RAW["coupons"]).collect()
    assert sorted((r.id, r.discount_percent) for r in rows) == [(1, 10.0), (2, None), (3, 30.0)]


def test_column_json_reads_source_sample(spark, scratch):
    d = scratch.replace("file:", "")
    p = _write(os.path.join(d, "c.json"), files.coupons_document(list(range(1, 11)), [10.0 * i for i in range(1, 11)]))
    df = files.read_json_columns(spark, [p], schemas.RAW["coupons"], positions=True)
    assert df.count() == 10
    assert df.agg(F.sum("discount_percent")).first()[0] == 550.0


def test_column_json_round_trip(spark, scratch):
    df = spark.range(25).select(F.col("id"), (F.col("id") * 1.5).alias("discount_percent"))
    files.write_json_columns(df, scratch + "/out", num_files=3)
    back = files.read_json_columns(spark, scratch + "/out", schemas.RAW["coupons"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1, "x")], "id bigint, zip_code string")
    b = spark.createDataFrame([(2,)], "id bigint")
    got = sorted(map(tuple, files.union_all_by_name([a, b]).collect()))
    assert got == [(1, "x"), (2, None)]


def test_column_json_from_pandas_with_dates(spark, scratch):
    import pandas as pd
    d = scratch.replace("file:", "")
    pdf = pd.DataFrame({"id": [1, 2], "customer_id": [5, 6], "login_successful": [True, False],
                        "attempted_at": pd.to_datetime(["2024-01-01 08:30:00.250", "2024-01-02 00:00:00.000"])})
    p = os.path.join(d, "logins.json")
    pdf.to_json(p, orient="columns")          # pandas' default layout: dates as epoch milliseconds
    rows = files.read_json_columns(spark, [p], schemas.RAW["login_attemps"]).orderBy("id").collect()
    assert [(r.id, r.customer_id, r.login_successful) for r in rows] == [(1, 5, True), (2, 6, False)]
    assert str(rows[0].attempted_at) == "2024-01-01 08:30:00.250000"
    assert str(rows[1].attempted_at) == "2024-01-02 00:00:00"
    iso = os.path.join(d, "logins_iso.json")
    pdf.to_json(iso, orient="columns", date_format="iso")
    rows = files.read_json_columns(spark, [iso], schemas.RAW["login_attemps"]).orderBy("id").collect()
    assert str(rows[0].attempted_at) == "2024-01-01 08:30:00.250000"


def test_json_records_from_pandas_with_dates(spark, scratch):
    import pandas as pd
    d = scratch.replace("file:", "")
    pdf = pd.DataFrame({"id": [1, 2], "customer_id": [5, 6], "login_successful": [True, False],
                        "attempted_at": pd.to_datetime(["2024-01-01 08:30:00.250", "2024-01-02 00:00:00.000"])})
    p = os.path.join(d, "logins.jsonl")
    pdf.to_json(p, orient="records", lines=True)          # dates as epoch milliseconds
    rows = files.read_json_records(spark, [p], schemas.RAW["login_attemps"], positions=True).orderBy("id").collect()
    assert [str(r.attempted_at) for r in rows] == ["2024-01-01 08:30:00.250000", "2024-01-02 00:00:00"]
    assert "_file_ordinal" in rows[0].asDict()
