import random

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("node", T.StringType()), T.StructField("digest", T.StringType())])


def make(spark, rows):
    """Documents with columns beyond the usual ones, whose names the operators use inside."""
    return spark.createDataFrame([Row(doc_id=i, text=t, lang="en", source=s, n_chars=None if t is None else len(t), node="x", digest="y") for i, t, s in rows], DOCS)


def word_rows(n, seed=0):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    return [[rng.choice(words) for _ in range(rng.choice((3, 4, 5, 20, 60, 200)))] for _ in range(n)], rng, words


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    body, rng, words = word_rows(60)
    rows = [(i, " ".join(w), f"s{i % 3}") for i, w in enumerate(body)]
    rows += [(100, None, "s0"), (101, "", "s1"), (None, "alpha beta gamma delta epsilon", None), (102, " \n\t ", None), (103, "one", "s2")]
    rows += [(i + 200, rows[i][1], "s0") for i in range(10)] + [rows[20]] * 3
    near = list(body[-1] * 2)
    for k in range(8):
        w = list(near) + ["x"] * 40
        w[rng.randrange(len(w))] = "edited"
        rows.append((300 + k, " ".join(w), "s1"))
    rows.append((400, " ".join(rng.choice(words) for _ in range(30_000)), "s2"))
    return make(spark, rows).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return make(spark, [])
