"""Learners have no SQL: check shapes, invariants and repeatability."""

import math
import threading

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from tallyloom.functions import keys
from tallyloom.operators import classify, content, factorise, features, topics, tuning
from tallyloom.plans import inputs, postings, ratings, tweets
from tallyloom.sources import writers

@pytest.fixture(scope="module")
def posts(spark, medium):
    return postings.prepared(inputs.postings(spark, medium))

@pytest.fixture(scope="module")
def ready(posts):
    return classify.build_features(posts, 50)

def test_prepared_postings(posts):
    assert posts.columns == ["job_id", "label", *classify.FLAGS, *classify.WORDS]
    counts = {r.label: r["count"] for r in posts.groupBy("label").count().collect()}
    assert counts == {0.0: 337, 1.0: 56}

def test_only_train_rows_are_balanced(posts, ready):
    train, test = classify.split(posts)
    assert ready.test.count() == test.count() == 114
    counts = {r.label: r["count"] for r in ready.train.groupBy("label").count().collect()}
    assert set(counts) == {0.0, 1.0} and 0.5 < counts[0.0] / counts[1.0] < 2
    assert ready.train.count() < train.count()

def test_features_have_no_overlap_and_full_width(ready):
    assert ready.width == 103
    size = ready.train.select(F.unwrap_udt("features")["size"].alias("n"))
    dense = ready.train.select(F.size(F.unwrap_udt("features")["values"]).alias("n"))
    assert {r.n for r in size.collect()} | {r.n for r in dense.collect()} >= {103}
    assert ready.train.join(ready.test, "job_id").count() == 0

@pytest.mark.parametrize(
    "name, grid",
    [
        ("logistic", {"maxIter": [5], "regParam": [0.2]}),
        ("svc", {"maxIter": [3], "regParam": [0.4]}),
        ("forest", {"numTrees": [5], "maxDepth": [3]}),
        ("mlp", {"maxIter": [3], "layers": [[103, 8, 2]]}),
    ],
)
def test_learners_predict_classes_and_repeat(ready, name, grid):
    runs = [classify.train_and_score(name, ready, **grid) for _ in range(2)]
    rows = [sorted(tuple(r) for r in run.scored.collect()) for run in runs]
    assert rows[0] == rows[1]
    assert len(rows[0]) == ready.test.count()
    assert {r[2] for r in rows[0]} <= {0.0, 1.0}

def test_report_holds_parameters_and_metrics(ready):
    done = classify.train_and_score("logistic", ready, maxIter=[4], regParam=[0.3])
    rows = {(r.kind, r.name): r.value for r in classify.report([done]).collect()}
    assert rows["param", "regParam"] == "0.3" and rows["param", "maxIter"] == "4"
    assert 0 <= float(rows["metric", "f1"]) <= 1
    assert ("metric", "accuracy") in rows

def test_one_point_grid_runs_its_folds_and_is_fitted_on_all_rows(ready):
    key = F.concat(F.lit("fold:"), F.col("job_id").cast("string"))
    lr = LogisticRegression()
    points = tuning.grid(lr, maxIter=[5], regParam=[0.1])
    full = tuning.cross_validate(lr, points, BinaryClassificationEvaluator(), ready.train, key, 2, parallel=1)
    assert len(full.fold_metrics) == 1
    plain = lr.fit(ready.train, points[0])
    assert plain.coefficients.toArray() == pytest.approx(full.model.coefficients.toArray())

class Together(LogisticRegression):
    """Fits only when as many others have come to the same point."""

    barrier = None

    def fit(self, dataset, params=None):
        Together.barrier.wait(120)
        return super().fit(dataset, params)

@pytest.mark.parametrize("regularised, fits", [([0.1], 4), ([0.1, 0.2], 6)])
def test_folds_run_side_by_side(ready, regularised, fits):
    key = F.concat(F.lit("fold:"), F.col("job_id").cast("string"))
    lr = Together()
    points = tuning.grid(lr, maxIter=[2], regParam=regularised)
    Together.barrier = threading.Barrier(fits, action=lambda: setattr(Together, "barrier", threading.Barrier(1)))
    found = tuning.cross_validate(lr, points, BinaryClassificationEvaluator(), ready.train, key, 3, parallel=fits)
    plain = LogisticRegression()
    points = tuning.grid(plain, maxIter=[2], regParam=regularised)
    theirs = CrossValidator(estimator=plain, estimatorParamMaps=points, numFolds=3, foldCol="fold",
                            evaluator=BinaryClassificationEvaluator())
    theirs = theirs.fit(ready.train.withColumn("fold", keys.fold_number(key, 3)))
    assert found.fold_metrics == pytest.approx(theirs.avgMetrics, abs=1e-12)
    assert found.model.coefficients.toArray() == pytest.approx(theirs.bestModel.coefficients.toArray())

def test_a_fold_out_of_range_is_an_error(ready):
    lr = LogisticRegression(maxIter=1)
    for key in (F.lit(7), F.lit(None).cast("int")):
        with pytest.raises(Exception, match="fold number must be in"):
            tuning.cross_validate(lr, [{}], BinaryClassificationEvaluator(), ready.train, key, 2, keyed=False)

def test_full_searches_have_all_their_fits():
    sizes = {n: 1 for n in classify.GRIDS}
    assert {n: math.prod(map(len, g.values())) for n, g in classify.GRIDS.items()} == sizes
    fits = [math.prod(map(len, g.values())) * f + 1 for g, f in (
        (classify.GRIDS["mlp"], classify.FOLDS), (tweets.TFIDF_GRID, tweets.FOLDS),
        (factorise.FULL_GRID, factorise.FOLDS), (content.FULL_GRID, content.FOLDS))]
    assert fits == [11, 3, 91, 31]

def test_search_keeps_the_better_point(spark, ready):
    tuned = classify.search("logistic", ready, 2, maxIter=[5], regParam=[0.01, 50.0])
    table = tuned.search(spark).collect()
    assert len(table) == 2 and len({r.params for r in table}) == 2
    best = max(range(2), key=lambda i: tuned.fold_metrics[i])
    assert tuned.model.getRegParam() == [0.01, 50.0][best]

def test_vocabulary_width_counts_all_terms(posts):
    terms = posts.select(F.explode("description")).distinct().count()
    assert features.vocabulary_width(posts, "description") == terms
    assert features.vocabulary_width(posts.limit(0), "description") == 1

@pytest.fixture(scope="module")
def english(spark, small):
    docs = inputs.tweets(spark, small).filter("lang = 'en'")
    return tweets.tokenised(docs, "doc_id", "tweet")

def test_topics(spark, english, tmp_path):
    model = topics.fit(topics.counts_pipeline(500, k=3), english)
    shares = topics.doc_topics(model, english, "doc_id")
    sums = shares.groupBy("doc_id").agg(F.sum("weight").alias("s"), F.count("*").alias("n"))
    for r in sums.collect():
        assert r.n == 3 and (math.isclose(r.s, 1, abs_tol=1e-6) or r.s == 0)

    words = topics.topic_words(model, 10).collect()
    assert len(words) == 30 and len({(r.topic, r.rank) for r in words}) == 30
    lists = {r.topic: r.words for r in topics.topic_word_lists(model, 10).collect()}
    ranked = sorted((r.topic, r.rank, r.term) for r in words)
    assert lists == {t: [w for k, _, w in ranked if k == t] for t in range(3)}
    matrix = topics.topic_terms(model)
    assert matrix.count() == 3 * len(model.stages[0].vocabulary)

    path = str(tmp_path / "model")
    writers.save_model(model, path)
    again = topics.doc_topics(writers.load_model(path), english, "doc_id")
    assert shares.join(again, ["doc_id", "topic"]).count() == shares.count()

@pytest.mark.parametrize("with_topics", [False, True])
def test_sentiment_model(spark, medium, with_topics):
    rows = tweets.labelled(
        inputs.tweets(spark, medium), inputs.lexicon(spark, medium), "doc_id", "tweet"
    )
    model = tweets.train_sentiment(rows, "doc_id", with_topics)
    scored = model.scored.cache()
    assert {r.label for r in scored.select("label").distinct().collect()} == {0, 1}
    want = BinaryClassificationEvaluator(rawPredictionCol="score").evaluate(
        scored.withColumn("label", F.col("label").cast("double"))
    )
    assert model.area_under_roc.first().value == pytest.approx(want, abs=1e-3)

def test_recommenders(spark, small):
    data = ratings.split_ratings(inputs.ratings(spark, small))
    grid = {"maxIter": [3], "rank": [4], "regParam": [0.1]}
    model = factorise.fit(data.train, grid)
    scored = factorise.predict(model, data.test).collect()
    assert scored and all(math.isfinite(r.prediction) for r in scored)
    top = factorise.top_items(model, data.test, 3)
    assert top.groupBy("user_id").count().filter("count <> 3").isEmpty()

    out = content.fit_predict(
        data.train, data.test, inputs.items(spark, small), {"maxIter": [5], "regParam": [0.1]}
    )
    assert out.count() == data.test.count()
    assert all(0 < r.prediction < 6 for r in out.collect())

def test_hybrid_scores(spark, small):
    result = ratings.hybrid(
        inputs.ratings(spark, small),
        inputs.items(spark, small),
        {"maxIter": [3], "rank": [4], "regParam": [0.1]},
        {"maxIter": [5], "regParam": [0.1]},
    )
    scores = result.scores().collect()
    assert len(scores) == 15
    rmse = {r.model: r.value for r in scores if r.metric == "rmse"}
    mse = {r.model: r.value for r in scores if r.metric == "mse"}
    assert all(rmse[m] == pytest.approx(mse[m] ** 0.5, abs=1e-4) for m in rmse)
