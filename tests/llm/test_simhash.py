import re

import numpy as np
import pytest
import xxhash

from tallyloom.llm import simhash
from tallyloom.llm.components import components

from .conftest import ROWS


def brute_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_labels(count, edges):
    parent = list(range(count))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(x) for x in range(count)]


def near_pairs(fps, radius=3):
    return [(i, j) for j in range(len(fps)) for i in range(j) if (fps[i] ^ fps[j]).bit_count() <= radius]


def noisy(rng, count, most):
    """Fingerprints around few centres, some of them in chains."""
    centres = rng.integers(0, 2**63, max(1, count // 8), dtype=np.uint64)
    fps = centres[rng.integers(0, len(centres), count)].copy()
    for i in range(count):
        for bit in rng.integers(0, 64, rng.integers(0, most + 1)):
            fps[i] ^= np.uint64(1) << np.uint64(bit)
    return np.unique(fps)


@pytest.mark.parametrize("text", [r[1] for r in ROWS] + ["a", "a b", "a b c", "É b\x1cc d", "A\x0bB\x0cC d"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("count", [1, 2, 63, 64, 65, 200, 500])
@pytest.mark.parametrize("radius", [0, 1, 3, 4])
def test_links_of_one_bucket(count, radius):
    rng = np.random.default_rng(count)
    fps = noisy(rng, count, 3)
    a, b = simhash.bucket_links(np.zeros(len(fps), int), fps, radius)
    place = {int(f): i for i, f in enumerate(fps)}
    got = brute_labels(len(fps), [(place[int(x)], place[int(y)]) for x, y in zip(a, b)])
    assert got == brute_labels(len(fps), near_pairs(fps.tolist(), radius))
    assert len(a) < max(1, len(fps))


def test_buckets_are_kept_apart():
    fps = np.array([5, 5 ^ 1, 5, 5 ^ 2], np.uint64)
    a, b = simhash.bucket_links(np.array([0, 1, 2, 2]), fps, 3)
    assert {frozenset(map(int, p)) for p in zip(a, b)} == {frozenset({5, 7})}


@pytest.mark.parametrize("bucket", [4096, 7])
def test_links_and_components(spark, odd, bucket):
    rng = np.random.default_rng(5)
    fps = noisy(rng, 400, 4)
    nodes = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    edges = simhash.links(nodes, 3, bucket)
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    labels = brute_labels(len(fps), near_pairs(fps.tolist()))
    signed = fps.view(np.int64).tolist()
    want = {}
    for f, label in zip(signed, labels):
        want.setdefault(label, set()).add(f)
    got = {}
    for f in signed:
        got.setdefault(roots.get(f, f), set()).add(f)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 501)], "u long, v long")
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    assert roots == {i: 0 for i in range(1, 101)} | {501: 500}


def test_near_duplicates_of_odd_rows(odd):
    fps = [brute_fingerprint(r[1]) for r in ROWS]
    labels = brute_labels(len(fps), near_pairs(fps))
    ids = {}
    for r, label in zip(ROWS, labels):
        ids.setdefault(label, []).append(r[0])
    least = {k: min((i for i in v if i is not None), default=None) for k, v in ids.items()}
    want = sorted(((r[0], f, least[k]) for r, f, k in zip(ROWS, fps, labels)), key=repr)
    rows = simhash.near_duplicates(odd).collect()
    assert sorted(((r[0], r[1] % 2**64, r[2]) for r in rows), key=repr) == want
    kept = simhash.keep(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted(least.values(), key=repr)


def test_empty_table(nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.keep(nothing).count() == 0
