"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL-proximal.

Words are runs between white space. Four families of n-grams are hashed to ``WIDTH`` slots:
words and pairs of words, lower-cased, and single, double and triple word forms. A form keeps
what kinds of signs a word has and in which order (``Xx,``), or that it repeats the word before
it. A feature's value is its share of the text's n-grams of its family, so a score is a sparse
dot product of shares and weights, put through the logistic function.

The weights are learned by follow-the-regularised-leader updates, one text after another, in one
task, over ``EPOCHS`` rounds of at most ``MAX_LABELLED`` labelled texts, those whose id has the
smallest hash. That bound also holds what the task reads; every text is scored.

NULL and empty texts have no n-grams: their score is that of the constant alone. NULL labels
are left out, and so are labels without a document; a document labelled twice counts twice.
Without any label every score is 0.5. NULL ids and repeated rows stay as they are. An empty
table gives an empty result. Other columns of the inputs are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom import store
from tallyloom.llm import common

WIDTH = 1 << 18
MAX_LABELLED = 8_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
LIMIT = 200_000
KEPT_SIGNS = 64
REPEATED = np.uint32(1)
MIX = np.uint32(0x9E3779B1)
FAMILIES = 5


def form(word: str) -> str:
    """The kinds of signs of a word, each run once: x, X, Xx, 0 or the sign itself."""
    if word.isalpha():
        if word.islower():
            return "x"
        if word.isupper():
            return "X" if len(word) > 1 else "Xx"
    kinds = ("x" if c.islower() else "X" if c.isupper() else "0" if c.isdigit() else c for c in word)
    return "".join(kind for kind, _ in groupby(kinds))


class Words:
    """Hashes of words and of their forms; those of the first ``LIMIT`` words of at most
    ``KEPT_SIGNS`` signs are kept."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, int]] = {}

    def hashes(self, word: str) -> tuple[int, int]:
        found = self.known.get(word)
        if found is None:
            found = zlib.crc32(word.lower().encode()), zlib.crc32(form(word).encode(), 7)
            if len(self.known) < LIMIT and len(word) <= KEPT_SIGNS:
                self.known[word] = found
        return found


def _join(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    mixed = (first * MIX) ^ then
    return mixed ^ (mixed >> np.uint32(15))


def ngrams(texts: pa.Array, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots (family by word), the same shape of shares, and where each text's words begin.

    Column i belongs to the n-grams that end with word i; the share is 0 where a text has too
    few words before it. Slot 0 is the constant's.
    """
    split = pc.utf8_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    runs = split.flatten()
    keep = pc.not_equal(runs, "")
    starts = np.concatenate([[0], np.cumsum(keep.to_numpy(zero_copy_only=False))])
    starts = starts[split.offsets.to_numpy() - split.offsets[0].as_py()]
    coded = runs.filter(keep).dictionary_encode()
    table = [words.hashes(w) for w in coded.dictionary.to_numpy(zero_copy_only=False).tolist()]
    table = np.array(table, np.uint32).reshape(-1, 2)
    code = coded.indices.to_numpy()
    count = np.diff(starts)
    place = np.arange(len(code)) - np.repeat(starts[:-1], count)
    word, shape = table[code, 0], table[code, 1].copy()
    again = np.concatenate([[False], code[1:] == code[:-1]])[: len(code)] & (place > 0)
    shape[again] = REPEATED
    word_1, shape_1 = np.roll(word, 1), np.roll(shape, 1)
    pair = _join(shape_1, shape)
    families = [word, _join(word_1, word), shape, pair, _join(np.roll(shape, 2), pair)]
    slots = np.stack([_join(np.full_like(f, i + 11), f) for i, f in enumerate(families)])
    slots = slots % np.uint32(WIDTH - 1) + np.uint32(1)
    shares = np.zeros(slots.shape, np.float32)
    for i, length in enumerate((1, 2, 1, 2, 3)):
        full = np.maximum(count - length + 1, 1)
        shares[i] = (place >= length - 1) / np.repeat(full, count)
    return slots, shares, starts


def features(texts: pa.Array, words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slots and values of each text, every slot once."""
    slots, shares, starts = ngrams(texts, words)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        slot, where = np.unique(slots[:, a:b].ravel(), return_inverse=True)
        value = np.bincount(where, shares[:, a:b].ravel(), len(slot)).astype(np.float32)
        yield np.append(slot[value > 0], np.uint32(0)).astype(np.int32), np.append(value[value > 0], np.float32(1))


def scores(texts: pa.Array, weights: np.ndarray, words: Words) -> np.ndarray:
    slots, shares, starts = ngrams(texts, words)
    each = (weights[slots] * shares).sum(axis=0, dtype=float)
    total = np.concatenate([[0.0], np.cumsum(each)])
    return 1 / (1 + np.exp(-(total[starts[1:]] - total[starts[:-1]] + weights[0])))


class Leader:
    """Weights by FTRL-proximal: sums of adjusted gradients and of their squares."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros(WIDTH), np.zeros(WIDTH)

    def weights(self, slots) -> np.ndarray:
        z, n = self.z[slots], self.n[slots]
        size = np.maximum(np.abs(z) - L1, 0)
        return -np.sign(z) * size / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, slots: np.ndarray, values: np.ndarray, label: int) -> None:
        weights = self.weights(slots)
        error = 1 / (1 + np.exp(-float(weights @ values))) - label
        slope = error * values
        root = np.sqrt(self.n[slots] + slope * slope)
        self.z[slots] += slope - (root - np.sqrt(self.n[slots])) / ALPHA * weights
        self.n[slots] += slope * slope


def fit(docs: DataFrame, labels: DataFrame, usable: Column, limit: int = MAX_LABELLED) -> np.ndarray:
    """Weights learned from the documents of ``labels`` (doc_id, label 0 or 1) with ``usable`` ids."""
    known = common.take(labels, "doc_id", "label").where(usable & F.col("label").isNotNull())
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(limit)
    texts = common.take(docs, "doc_id", "text").join(F.broadcast(some), "doc_id")  # at most ``limit`` rows

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            rows = list(features(batch.column(1), words))
            columns = [
                batch.column(0),
                batch.column(2).cast(pa.int32()),
                pa.array([slots for slots, _ in rows], pa.list_(pa.int32())),
                pa.array([values for _, values in rows], pa.list_(pa.float32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "slots", "values"])

    schema = "doc_id long, label int, slots array<int>, values array<float>"
    rows = store.materialise(texts.mapInArrow(extract, schema), "labelled-features")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        leader = Leader()
        for _ in range(EPOCHS):
            for batch in held:
                for label, slots, values in zip(*(batch.column(i) for i in range(3))):
                    leader.learn(slots.values.to_numpy(), values.values.to_numpy(), label.as_py())
        weights = leader.weights(slice(None)).astype("<f4").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([weights], pa.binary())], ["weights"])

    ordered = rows.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "label")
    learned = ordered.select("label", "slots", "values").mapInArrow(train, "weights binary").collect()
    return np.frombuffer(learned[0][0], "<f4") if learned else np.zeros(WIDTH, "<f4")


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, score of every document."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            found = scores(batch.column(1), weights, words)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "score"])

    return common.take(docs, "doc_id", "text").mapInArrow(scored, "doc_id long, score double")
