"""Property tests: keep-last against pandas' drop_duplicates(keep='last'), upsert against a dict merge."""
import os

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tillstar import schemas
from tillstar.operators.dedup import keep_last
from tillstar.operators.upsert import upsert
from tillstar.sources import files

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(st.tuples(st.integers(0, 6), st.text("abc", min_size=1, max_size=3)), min_size=1, max_size=40)


@SETTINGS
@given(files_rows=st.lists(rows_st, min_size=1, max_size=4))
def test_keep_last_matches_pandas(spark, tmp_path_factory, files_rows):
    d = tmp_path_factory.mktemp("kl")
    paths = []
    for i, rows in enumerate(files_rows):
        p = os.path.join(d, f"f{i}.csv")
        pd.DataFrame(rows, columns=["id", "name"]).to_csv(p)          # pandas layout: unnamed index column
        paths.append(p)
    expected = (pd.concat([pd.read_csv(p) for p in paths]).drop(columns=["Unnamed: 0"])
                .drop_duplicates(subset=["id"], keep="last"))
    got = keep_last(files.read_csv(spark, paths, schemas._s("id BIGINT, name STRING"), positions=True), ["id"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.itertuples(index=False)))


keyed_st = st.dictionaries(st.integers(0, 20), st.tuples(st.integers(0, 9), st.sampled_from("xyz")), max_size=15)


@SETTINGS
@given(target=keyed_st, source=keyed_st)
def test_upsert_matches_dict_merge(spark, target, source):
    schema = "k bigint, a bigint, b string"
    t = spark.createDataFrame([(k, a, b) for k, (a, b) in target.items()], schema)
    s = spark.createDataFrame([(k, a, b) for k, (a, b) in source.items()], schema)
    expected = dict(target)
    for k, (a, b) in source.items():
        expected[k] = (target[k][0], b) if k in target else (a, b)       # only "b" is updated on conflict
    got = {r.k: (r.a, r.b) for r in upsert(t, s, ["k"], ["b"]).collect()}
    assert got == expected


doc_st = st.dictionaries(st.integers(0, 500).map(str),
                         st.tuples(st.one_of(st.none(), st.integers(-5, 5)), st.one_of(st.none(), st.floats(0, 100))),
                         min_size=1, max_size=25)


@SETTINGS
@given(docs=st.lists(doc_st, min_size=1, max_size=3))
def test_column_json_matches_python(spark, tmp_path_factory, docs):
    import json
    d = tmp_path_factory.mktemp("cj")
    p = os.path.join(d, "docs.json")
    expected = []
    with open(p, "w") as f:
        for doc in docs:
            ids = {k: v[0] for k, v in doc.items() if v[0] is not None}
            pct = {k: v[1] for k, v in doc.items() if v[1] is not None}
            f.write(json.dumps({"id": ids, "discount_percent": pct}) + "\n")
            expected += [(ids.get(k), pct.get(k)) for k in set(ids) | set(pct)]
    got = [tuple(r) for r in files.read_json_columns(spark, [p], schemas.RAW["coupons"]).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
