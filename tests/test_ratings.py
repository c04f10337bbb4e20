"""Similarity, neighbours, baselines and blends against plain Python on hand-made ratings."""

import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyloom import store
from tallyloom.operators import blend, neighbours, pairs, similarity
from tallyloom.plans import ratings as plan

# User 1 rates every item; item 9 has no variance; items 5 and 6 tie.
RATINGS = (
    [(1, i, (i * 7) % 5 + 1) for i in range(1, 31)]
    + [(u, i, (u * i) % 5 + 1) for u in range(2, 12) for i in range(1, 9)]
    + [(u, 9, 3) for u in range(2, 8)]
    + [(20, 40, 5), (21, 2, 4)]
)
RATINGS = [r if r[1] != 9 else (r[0], 9, 3) for r in RATINGS]
SCHEMA = "user_id long, item_id long, rating int"


@pytest.fixture(scope="module")
def rows(spark):
    return store.materialise(spark.createDataFrame(RATINGS, SCHEMA), "test-ratings")


def brute_similarities(rows):
    by_item = defaultdict(list)
    for _, i, r in rows:
        by_item[i].append(r)
    mean = {i: sum(v) / len(v) for i, v in by_item.items()}
    by_user = defaultdict(dict)
    for u, i, r in rows:
        by_user[u][i] = r - mean[i]
    sums = defaultdict(lambda: [0.0, 0.0, 0.0, 0])
    for items in by_user.values():
        for i in items:
            for j in items:
                if i < j:
                    s = sums[i, j]
                    s[0] += items[i] * items[j]
                    s[1] += items[i] ** 2
                    s[2] += items[j] ** 2
                    s[3] += 1
    return {
        k: (xy / math.sqrt(xx * yy) if xx * yy > 0 else 0.0, n)
        for k, (xy, xx, yy, n) in sums.items()
    }


@pytest.mark.parametrize("block", [2048, 4, 7])
def test_similarities_are_the_same_for_any_block_size(spark, rows, block):
    load = pairs.user_load(rows, block)
    assert (load.active is None) == (block == 2048)
    means = store.materialise(similarity.item_means(rows), "test-means")
    got = {
        (r.item_i, r.item_j): (r.similarity, r.support)
        for r in similarity.item_similarities(rows, means, load).collect()
    }
    want = brute_similarities(RATINGS)
    assert got.keys() == want.keys()
    for k, (s, n) in want.items():
        assert got[k][1] == n and abs(got[k][0] - s) < 1e-5, k
    assert all(s == 0 for (i, j), (s, _) in got.items() if 9 in (i, j))


@pytest.mark.parametrize("tiles", [1, 2, 5])
def test_matches_of_two_items_meet_in_one_cell(spark, rows, tiles):
    """No row is needed twice, none is lost, and sums by pair need no shuffle of the matches."""
    twice = rows.union(rows.where("user_id = 21")).union(rows.selectExpr("NULL", "item_id", "rating").limit(5))
    found = pairs.matches_by_cell(twice, "item_id", "rating", pairs.UserLoad(None, 2, tiles))
    sums = found.groupBy("cell", F.col("a.id").alias("a"), F.col("b.id").alias("b")).count()
    assert sums._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2
    got = defaultdict(int)
    for r in sums.collect():
        pair = min(r.a, r.b), max(r.a, r.b)
        assert pair not in got
        got[pair] = r["count"]
    assert got == {k: n for k, (_, n) in brute_similarities(RATINGS).items()}


def test_a_list_is_no_longer_than_its_block_of_items(spark, monkeypatch):
    monkeypatch.setattr(pairs, "ROWS_PER_LIST", 20)
    rows = spark.range(400).selectExpr("1L user_id", "id item_id", "1 rating")
    load = pairs.user_load(rows)
    cells = pairs.matches_by_cell(rows, "item_id", "rating", load).groupBy("cell").count()
    sizes = [r["count"] for r in cells.collect()]
    assert load.tiles == 20 and sum(sizes) == 400 * 399 // 2 and max(sizes) < 2000


def test_active_user_work_is_spread(spark):
    """One user holding most rows: no join cell sees more than about block² matches."""
    rows = spark.range(400).selectExpr("1L user_id", "id item_id", "1 rating")
    load = pairs.user_load(rows, 50)
    assert load.active.first().blocks == 8
    cells = pairs._cells(rows, "item_id", load.active, "own", "other")
    assert cells.count() == 400 * 8
    sizes = [r["count"] for r in cells.groupBy("own", "other").count().collect()]
    assert len(sizes) == 64 and max(sizes) < 100


def test_partitions_follow_the_matches(spark, monkeypatch):
    monkeypatch.setattr(pairs, "MATCHES_PER_TASK", 1000)
    rows = spark.range(400).selectExpr("1L user_id", "id item_id", "1 rating")
    assert pairs.user_load(rows).partitions == 160
    assert pairs.user_load(rows.limit(0)).active is None


def test_min_support(spark, rows):
    means = store.materialise(similarity.item_means(rows), "test-means")
    kept = similarity.item_similarities(rows, means, pairs.user_load(rows), 5)
    want = {k for k, (_, n) in brute_similarities(RATINGS).items() if n >= 5}
    assert {(r.item_i, r.item_j) for r in kept.collect()} == want


@pytest.mark.parametrize("block", [2048, 3])
def test_predictions_by_brute_force(spark, block):
    source = spark.createDataFrame(RATINGS, SCHEMA)
    data = plan.split_ratings(source, block)
    train = [tuple(r) for r in data.train.collect()]
    test = [tuple(r) for r in data.test.collect()]
    assert sorted(train + test) == sorted(RATINGS) and test

    similar = {k: round(s, 6) for k, (s, _) in brute_similarities(train).items()}
    of_item, of_user = defaultdict(list), defaultdict(dict)
    for u, i, r in train:
        of_item[i].append(r)
        of_user[u][i] = r
    im = {i: sum(v) / len(v) for i, v in of_item.items()}
    um = {u: sum(v.values()) / len(v) for u, v in of_user.items()}
    middle = sum(im.values()) / len(im)

    def base(u, i):
        return um.get(u, middle) + im.get(i, middle) - middle

    want = {}
    for u, i, _ in test:
        near = sorted(
            (-similar[min(i, j), max(i, j)], j)
            for j in of_user[u]
            if (min(i, j), max(i, j)) in similar
        )[:10]
        pull = sum(-s * (of_user[u][j] - base(u, j)) for s, j in near)
        weight = sum(abs(s) for s, _ in near)
        want[u, i] = base(u, i) + (pull / weight if weight else 0.0)
    got = {(r.user_id, r.item_id): r.prediction for r in plan.neighbour_predictions(data).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert abs(got[k] - want[k]) < 1e-4, k


def test_cold_start_uses_what_is_known(spark):
    train = spark.createDataFrame([(1, 1, 5), (1, 2, 3)], SCHEMA)
    test = spark.createDataFrame([(1, 9, 4), (9, 1, 4), (9, 9, 4)], SCHEMA)
    out = neighbours.with_baseline(test, similarity.item_means(train), similarity.user_means(train))
    assert {(r.user_id, r.item_id): r.baseline for r in out.collect()} == {
        (1, 9): 4.0,
        (9, 1): 5.0,
        (9, 9): 4.0,
    }


def test_ties_go_to_the_lower_neighbour(spark):
    test = spark.createDataFrame([(1, 5)], "user_id long, item_id long")
    train = spark.createDataFrame([(1, i, 0.5) for i in (1, 2, 3)], "user_id long, item_id long, residual double")
    similar = spark.createDataFrame(
        [(1, 5, 0.5), (2, 5, 0.5), (3, 5, 0.9)], "item_i long, item_j long, similarity double"
    )
    near = neighbours.top_neighbours(test, train, similar, pairs.UserLoad(None, 2), 2).collect()
    assert sorted((r.rank, r.neighbour) for r in near) == [(1, 3), (2, 1)]


def test_candidates_and_scores_are_not_shuffled(spark, rows):
    """Lists and similarities go to strips; nothing after their join crosses the network."""
    similar = spark.createDataFrame([(1, 5, 0.5)], "item_i long, item_j long, similarity double")
    train = rows.selectExpr("user_id", "item_id", "1.0D residual")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        near = neighbours.top_neighbours(rows, train, similar, pairs.UserLoad(None, 3), 2)
        lines = near._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = [n for n, line in enumerate(lines) if "Exchange" in line]
    join = [n for n, line in enumerate(lines) if "neighbour" in line and "Join" in line]
    assert len(moved) == 4 and len(join) == 1 and min(moved) > join[0], "\n".join(lines)


def test_repeated_ratings_count_as_rows_and_bring_all_residuals(spark):
    test = spark.createDataFrame([(1, 5), (1, 5)], "user_id long, item_id long")
    train = spark.createDataFrame(
        [(1, 1, 0.5), (1, 1, None), (1, 2, 0.25), (2, 1, 0.125)], "user_id long, item_id long, residual double"
    )
    similar = spark.createDataFrame([(1, 5, 0.9), (2, 5, 0.5)], "item_i long, item_j long, similarity double")
    load = pairs.UserLoad(None, 2)
    for k, want in ((1, []), (2, []), (3, [(3, 2, 0.25)])):
        near = neighbours.top_neighbours(test, train, similar, load, k).collect()
        got = sorted((r["rank"], r.neighbour, r.residual or 0) for r in near)
        assert got == [(n, 1, x) for n in range(1, min(k, 2) + 1) for x in (0, 0.5)] + want


@pytest.mark.parametrize("most", [50_000, 2])
def test_hot_items_are_spread_over_strips(spark, monkeypatch, most):
    monkeypatch.setattr(neighbours, "ROWS_PER_STRIP", most)
    test = spark.range(40).selectExpr("id user_id", "5L item_id").union(spark.sql("SELECT 1L, 1L"))
    train = spark.range(40).selectExpr("id user_id", "explode(array(1L, 2L, 5L)) item_id", "0.5D residual")
    similar = spark.createDataFrame(
        [(1, 5, 0.5), (2, 5, 0.7), (1, 2, 0.1)], "item_i long, item_j long, similarity double"
    )
    hot = neighbours.hot_items(test, most, 16)
    assert (hot is None) if most > 40 else [tuple(r) for r in hot.collect()] == [(5, 16)]
    lists = neighbours._lists(test, train, hot, 16)
    assert (lists.select("strip").distinct().count() > 4) == (most == 2)
    near = neighbours.top_neighbours(test, train, similar, pairs.UserLoad(None, 16), 2).collect()
    got = sorted((r.user_id, r.item_id, r["rank"], r.neighbour, r.residual) for r in near)
    want = [(u, 5, k, 3 - k, 0.5) for u in range(40) for k in (1, 2)]
    assert got == sorted([*want, (1, 1, 1, 5, 0.5), (1, 1, 2, 2, 0.5)])


def test_blends(spark):
    def table(rows):
        return spark.createDataFrame(rows, "user_id long, item_id long, rating double, prediction double")

    a = table([(1, 1, 4.0, 1.0), (1, 2, 3.0, 2.0)])
    b = table([(1, 1, 4.0, 2.0), (2, 2, 3.0, 2.0)])
    c = table([(1, 1, 4.0, 3.0)])
    two = blend.blend(a, b).collect()
    assert [(r.user_id, r.item_id) for r in two] == [(1, 1)]
    assert two[0].prediction == pytest.approx(0.3 * 1 + 0.7 * 2)
    assert blend.blend_three(a, b, c).first().prediction == pytest.approx(1.7 * 0.8 + 3 * 0.2)


def test_residual_means(spark, rows):
    means = store.materialise(similarity.item_means(rows), "test-means")
    out = similarity.user_residual_means(rows, means)
    total = out.join(similarity.rating_totals(rows, "user_id"), "user_id").agg(
        F.sum(F.col("residual_mean") * F.col("n_ratings"))
    )
    assert abs(total.first()[0]) < 1e-9
