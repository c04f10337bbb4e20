"""HyperMinHash near-duplicates against brute force over the sets themselves."""

import random
import re

import numpy as np
import pytest

from tallyloom.llm import minhash

from .conftest import ROWS
from .test_simhash import brute_labels


def brute_set(text, words=2):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    parts = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(parts) < words:
        return {" ".join(parts)} if parts else set()
    return {" ".join(parts[i : i + words]) for i in range(len(parts) - words + 1)}


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) of each (doc_id, text)."""
    sets = [brute_set(text) for _, text in rows]
    edges = [
        (i, j)
        for j in range(len(rows))
        for i in range(j)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    ids = {}
    for (doc_id, _), label in zip(rows, brute_labels(len(rows), edges)):
        ids.setdefault(label, []).append(doc_id)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in ids.items()}
    labels = brute_labels(len(rows), edges)
    return [(r[0], len(s), least[k], r[0] == least[k]) for r, s, k in zip(rows, sets, labels)]


def got(rows):
    assert rows.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def test_sets():
    shingles = minhash.Shingles()
    for text in [r[1] for r in ROWS] + ["a", "a b", "a a a", "É b\x1cc d", "A\x0bB\x0cC d", "ab c", "a bc"]:
        assert len(shingles.of(text)) == len(brute_set(text))
    assert shingles.of("ab c")[0] != shingles.of("a bc")[0] != shingles.of("abc")[0]
    assert (shingles.of("A b c") == shingles.of("a B C")).all()


def test_registers_are_those_of_the_smallest_hashes():
    rng = np.random.default_rng(1)
    for count in (0, 1, 5, 300, 5000):
        found = np.unique(rng.integers(0, 2**64, count, dtype=np.uint64))
        want = np.zeros(minhash.BUCKETS, int)
        for h in sorted(map(int, found), reverse=True):
            bits = f"{h:064b}"
            rest = bits[8:]
            zeros = len(rest) - len(rest.lstrip("0"))
            after = (rest[zeros + 1 :] + "0" * 64)[: minhash.MANTISSA]
            want[int(bits[:8], 2)] = (zeros + 1) << minhash.MANTISSA | int(after, 2)
        assert minhash.registers(found).tolist() == want.tolist()


@pytest.mark.parametrize("size", [40, 400, 20_000])
def test_estimates_are_corrected_for_collisions(size):
    rng = np.random.default_rng(size)
    pool = rng.integers(0, 2**64, 3 * size, dtype=np.uint64)
    for shared in (0, size // 2, size * 8 // 9, size):
        found = []
        for k in range(40):
            order = rng.permutation(pool)
            a, b = np.sort(order[:size]), np.sort(order[size - shared : 2 * size - shared])
            estimate, _ = minhash.likely(
                minhash.registers(a)[None], np.array([size]), minhash.registers(b), size
            )
            found.append(estimate[0])
        assert abs(np.mean(found) - shared / (2 * size - shared)) < 0.02


def test_pairs_at_the_limit_share_a_band():
    rng, missed = np.random.default_rng(2), 0
    for size in (5, 9, 90, 900):
        for _ in range(150):
            pool = rng.integers(0, 2**64, size, dtype=np.uint64)
            a, b = np.sort(pool[: max(1, size * 8 // 10)] if size == 5 else pool[: size * 9 // 10]), np.sort(pool)
            keys = [minhash.bands(minhash.registers(np.unique(x))) for x in (a, b)]
            missed += not (keys[0] == keys[1]).any()
    assert missed == 0


def varied(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def test_groups_of_copies_and_chains(spark, odd):
    """Families around and over the limit, a hot one among them, with short and repeated texts."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for family in range(25):
        base = rng.choices(vocabulary, k=rng.choice([3, 8, 20, 60, 200]))
        for _ in range(rng.choice([1, 2, 6, 12])):
            rows.append(varied(rng, base, rng.randrange(0, 1 + len(base) // 8)))
    hot = rng.choices(vocabulary, k=100)
    rows += [varied(rng, hot, rng.randrange(0, 9)) for _ in range(150)]
    rows += ["one two", "one two", "one", "One", "", None, " "]
    rows = list(enumerate(rows, 100))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(minhash.near_duplicates(docs)) == sorted(brute(rows), key=repr)


@pytest.mark.parametrize("few", [2, 10, 64])
def test_large_buckets_and_cells_lose_nothing(spark, odd, monkeypatch, few):
    """Groups of large buckets in many small cells give what pairs of small ones give."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(60)]
    rows = list(enumerate(varied(rng, base, rng.randrange(0, 8)) for _ in range(80)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(minhash, "BLOCK", 7)
    monkeypatch.setattr(minhash, "PAIRS", 3)
    monkeypatch.setattr(minhash, "FEW", few)
    monkeypatch.setattr(minhash, "ASKED", 5)
    assert got(minhash.near_duplicates(docs)) == sorted(brute(rows), key=repr)


def test_odd_rows(odd):
    assert got(minhash.near_duplicates(odd)) == sorted(brute([r[:2] for r in ROWS]), key=repr)


def test_empty_table(nothing):
    assert minhash.near_duplicates(nothing).count() == 0
