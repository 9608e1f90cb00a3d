import datetime as dt
import os

from tillstar.operators import load
from tillstar.streaming.ingest import start_ingest


def _json(path, rows):
    import json
    with open(path, "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


def test_stream_ingest_keeps_last(spark, scratch):
    d = scratch.replace("file:", "")
    src = os.path.join(d, "in")
    os.makedirs(src)
    ts = lambda h: dt.datetime(2024, 1, 1, h).isoformat(timespec="microseconds")
    _json(os.path.join(src, "login_0.json"), [
        {"id": 1, "customer_id": 5, "login_successful": False, "attempted_at": ts(1)},
        {"id": 2, "customer_id": 6, "login_successful": True, "attempted_at": ts(2)},
        {"id": 1, "customer_id": 5, "login_successful": True, "attempted_at": ts(3)}])
    load.create_layer(spark, "t_stream", os.path.join(d, "db"))
    q = start_ingest(spark, "login_attemps", "json_records", src, "t_stream.logins", os.path.join(d, "ckpt"))
    q.awaitTermination(120)
    got = {r.id: (r.login_successful, r.attempted_at.hour) for r in spark.table("t_stream.logins").collect()}
    assert got == {1: (True, 3), 2: (True, 2)}
    # a later file overrides, and a restart does not replay processed files
    _json(os.path.join(src, "login_1.json"), [
        {"id": 2, "customer_id": 6, "login_successful": False, "attempted_at": ts(4)},
        {"id": 3, "customer_id": 7, "login_successful": True, "attempted_at": ts(5)}])
    q = start_ingest(spark, "login_attemps", "json_records", src, "t_stream.logins", os.path.join(d, "ckpt"))
    q.awaitTermination(120)
    spark.catalog.refreshTable("t_stream.logins")   # micro-batches swapped the table in another session
    got = {r.id: (r.login_successful, r.attempted_at.hour) for r in spark.table("t_stream.logins").collect()}
    assert got == {1: (True, 3), 2: (False, 4), 3: (True, 5)}
