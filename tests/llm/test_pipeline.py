"""The stages one by one against what their operators promise, by brute force."""

import numpy as np

import corpus_pipeline
from tallyloom import store
from tallyloom.llm import pii

from .test_exact_dedup import brute as exact_groups
from .test_pii import brute as base_spans
from .test_simhash import brute_fingerprint, brute_labels, near_pairs
from .test_tokens import check_packed, library_ids


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, held = docs.columns, {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = store.materialise(stage(spark, docs, small), f"test-{name}")
        held[name] = docs.collect()
        assert name == "packed" or docs.columns == columns
    assert {r["doc_id"] for r in held["language"]} == {
        r["doc_id"] for r in held["documents"] if any(c.isalpha() for c in r["text"])
    }
    groups = exact_groups([(r["doc_id"], r["text"]) for r in held["language"]])
    assert sorted(r["doc_id"] for r in held["exact"]) == sorted(i for i, _, _, kept in groups if kept)
    fps = [brute_fingerprint(r["text"]) for r in held["exact"]]
    labels = brute_labels(len(fps), near_pairs(fps))
    least = {}
    for r, label in zip(held["exact"], labels):
        least[label] = min(r["doc_id"], least.get(label, r["doc_id"]))
    assert sorted(r["doc_id"] for r in held["near"]) == sorted(least.values())
    before = {r["doc_id"]: r["text"] for r in held["near"]}
    assert set(before) == {r["doc_id"] for r in held["private"]}
    for r in held["private"]:
        assert base_spans(r["text"]) == [] and r["n_chars"] == len(r["text"])
        if not pii.candidates(before[r["doc_id"]]):
            assert r["text"] == before[r["doc_id"]]
    ids = {}
    for r in sorted(held["packed"], key=lambda r: r["piece"]):
        assert r["start"] == len(ids.get(r["doc_id"], []))
        ids.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert ids == {r["doc_id"]: [*library_ids(r["text"]), 0] for r in held["private"]}
    check_packed(held["packed"], 2048)


def test_stages_take_odd_rows(spark, odd, small):
    docs = odd.toDF(*odd.columns[:-2], "more", "fp")  # Parquet takes no names that differ in case only
    for name, stage in corpus_pipeline.STAGES:
        docs = store.materialise(stage(spark, docs, small), f"odd-{name}")
    # Alike: 1 and 2, 8 and 9, both rows without an id; without letters: 3 to 6.
    assert sorted({r["doc_id"] for r in docs.collect()}, key=repr) == sorted([2, 7, 9, None, 10, 11], key=repr)


def test_stages_take_an_empty_table(spark, nothing, small):
    docs = nothing.toDF(*nothing.columns[:-2], "more", "fp")
    for name, stage in corpus_pipeline.STAGES:
        docs = store.materialise(stage(spark, docs, small), f"none-{name}")
    assert docs.count() == 0


def test_run_is_the_last_stage(spark, small):
    rows = corpus_pipeline.run(spark, small)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]
    check_packed(rows.collect(), 2048)
