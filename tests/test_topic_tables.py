"""Topics as tables against MLlib's own model of the same vectors."""

import numpy as np
import pytest
from pyspark.ml.clustering import DistributedLDAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyloom import store
from tallyloom.functions import vectors
from tallyloom.operators import features, terms, topics
from tallyloom.plans import inputs, queries, tweets


@pytest.fixture(scope="module")
def counted(spark, small):
    docs = inputs.tweets(spark, small).filter("lang = 'en'").limit(60)
    docs = tweets.tokenised(docs.unionByName(docs.limit(1).selectExpr("-1L AS doc_id", "'' AS tweet", "lang")), "doc_id", "tweet")
    words = docs.select("doc_id", F.explode("words").alias("term")).where("term <> ''")
    tf = store.materialise(terms.term_frequencies(words, "doc_id"), "test-frequencies")
    return features.count_vectors(tf, docs, "doc_id"), tf, docs


def test_vectors_hold_the_frequencies(counted):
    made, tf, docs = counted
    rows = vectors.vector_rows(made.vectors, "doc_id", "counts").join(made.ids, F.col("index") == F.col("term_id"))
    got = {(r.doc_id, r.term, int(r.value)) for r in rows.collect()}
    assert got == {(r.doc_id, r.term, r.tf) for r in tf.collect()}
    assert made.vectors.count() == docs.count()
    sizes = made.vectors.select(F.unwrap_udt("counts")["size"].alias("n"), F.unwrap_udt("counts")["indices"].alias("i"))
    assert {r.n for r in sizes.collect()} == {made.width} and all(r.i == sorted(r.i) for r in sizes.collect())


@pytest.fixture(scope="module")
def fitted(counted):
    paths, one = [], store.new_path
    store.new_path = lambda spark, name: paths.append(one(spark, name)) or paths[-1]
    try:
        table = topics.fit_table(counted[0], 3)
    finally:
        store.new_path = one
    return table, DistributedLDAModel.load(next(p for p in paths if "topic-vertices" in p))


def test_weights_are_those_of_the_model(counted, fitted):
    table, model = fitted
    theirs = model.describeTopics(counted[0].width).select(
        "topic", F.explode(F.arrays_zip(F.col("termIndices").alias("i"), F.col("termWeights").alias("w"))).alias("e")
    )
    names = {r.term_id: r.term for r in table.ids.collect()}
    want = {(r.topic, names[r.e.i]): r.e.w for r in theirs.collect()}
    rows = topics.table_words(table).collect()
    got = {(r.topic, r.term): r.weight for r in rows}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)
    for topic in range(3):
        ranked = sorted((r for r in rows if r.topic == topic), key=lambda r: r["rank"])
        assert [r["rank"] for r in ranked] == list(range(1, counted[0].width + 1))
        assert ranked == sorted(ranked, key=lambda r: (-r.weight, r.term))
    top = {tuple(r) for r in topics.table_words(table, 7).collect()}
    assert top == {tuple(r) for r in rows if r["rank"] <= 7}


def test_shares_are_those_of_the_model(counted, fitted):
    table, model = fitted
    made, tf, docs = counted
    theirs = model.transform(made.vectors).select("doc_id", vector_to_array("topicDistribution").alias("shares"))
    want = {r.doc_id: r.shares for r in theirs.collect() if sum(r.shares)}
    got = {}
    for r in topics.fold_in(table, tf, "doc_id").collect():
        got.setdefault(r.doc_id, {})[r.topic] = r.weight
    assert got.keys() == want.keys() and -1 not in got
    for doc, shares in got.items():
        assert sum(shares.values()) == pytest.approx(1)
        assert [shares[k] for k in range(3)] == pytest.approx(want[doc], abs=1e-3)


def test_documents_that_the_fit_has_not_seen(spark, counted, fitted):
    table, _ = fitted
    word = table.ids.first().term
    rows = [("new", word, 3), ("new", "a word that no topic knows", 1), ("other", "unknown", 2)]
    got = topics.fold_in(table, spark.createDataFrame(rows, "doc_id string, term string, tf long"), "doc_id").collect()
    assert {r.doc_id for r in got} == {"new"} and sum(r.weight for r in got) == pytest.approx(1)


def test_digamma():
    x = np.array([1e-3, 0.5, 1.0, 2.0, 10.0, 1e6])
    want = [-1000.5755719318103, -1.9635100260214235, -0.5772156649015329, 0.42278433509846714, 2.251752589066721, 13.815510057964191]
    assert topics.digamma(x) == pytest.approx(want, rel=1e-8)


def test_count_vectors_are_weighted_by_number(spark, small, monkeypatch):
    """Document frequencies are counted and joined by term number, not by the words themselves."""
    written, one = {}, store.materialise
    monkeypatch.setattr(store, "materialise", lambda df, name: written.setdefault(name, one(df, name)))
    rows = queries.QUERIES["count_vectors"](spark, small)
    assert dict(written["document-frequencies"].dtypes)["term"] == "int"
    assert dict(rows.dtypes)["term"] == "string"
    assert rows.count() == written["word-frequencies"].count()
