import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import topk

SCHEMA = "vec_id long, embedding array<float>, VEC_ID string, score int"


def brute(rows, k, scale=1024):
    usable = [
        (i, [math.floor(scale * float(x)) for x in v])
        for i, v, *_ in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in usable:
        if q is None or q % 100:
            continue
        scores = [(-sum(x * y for x, y in zip(a, b)), i is None, i or 0, i) for i, b in usable if i != q and len(a) == len(b)]
        out += [(q, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def got(spark, rows, **more):
    table = spark.createDataFrame(rows, SCHEMA)
    found = topk.top_k(table, F.col("vec_id") % 100 == 0, **more)
    return sorted(map(tuple, found.select("query_id", "rank", "vec_id", "score").collect()), key=repr)


@pytest.fixture(scope="module", autouse=True)
def shipped(odd):
    pass


@pytest.mark.parametrize("shard_rows", [50, 200, 10_000])
def test_against_brute_force(spark, shard_rows):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(5, 8))
    same = centres[0].astype(np.float32).tolist()
    rows = [(i, (centres[i % 5] + rng.normal(size=8) * 0.2).astype(np.float32).tolist(), "x", 1) for i in range(500)]
    rows += [(1000 + i, same, "x", 1) for i in range(250)]
    assert got(spark, rows, shard_rows=shard_rows) == brute(rows, 10)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0], "x", 1), (1, [0.5, float("nan")], "x", 1), (2, [None, 1.0], "x", 1), (3, None, "x", 1),
        (4, [float("inf"), 0.0], "x", 1), (5, [], "x", 1), (100, [], "x", 1), (6, [1.0, 2.0], "x", 1),
        (6, [1.0, 2.0], "x", 1), (None, [1.0, 2.0], "x", 1), (200, [3.0], "x", 1), (7, [-0.0001, 0.0], "x", 1),
        (300, [1e30, 1.0], "x", 1), (8, [-1e30, 1.0], "x", 1),
    ]
    top = [(q, r, i, min(max(s, topk.LOWEST), topk.HIGHEST)) for q, r, i, s in brute(rows, 3)]
    assert [r for r in got(spark, rows, k=3) if r[0] != 300] == [r for r in top if r[0] != 300]
    assert [r[3] for r in got(spark, rows, k=3) if r[0] == 300] == [r[3] for r in top if r[0] == 300]


def test_nothing_to_search(spark):
    assert got(spark, [(0, [1.0], "x", 1)]) == []
    table = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(table, F.col("vec_id") % 100 == 0).count() == 0
