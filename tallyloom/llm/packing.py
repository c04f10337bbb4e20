"""Packing token sequences into as few bins of one capacity as it can.

Documents are cut into pieces of at most ``capacity`` ids. What has to be packed is then the
histogram of piece lengths, at most ``capacity`` numbers whatever the size of the corpus, and
the packing is a plan over it:

* The *configuration linear program* asks for the smallest number of bins, each filled after
  some configuration (how many pieces of each length), that covers the histogram.
* *Multiplicative weights* solve it (``weights``). A round finds the best configurations under
  the current weights by the knapsack dynamic program (``knapsack``), plays all that are within
  ``EPSILON`` of the best, and lowers the weight of lengths they cover too often and raises
  that of the others. The weights of the round with the best lower bound are kept.
* *Rounding* (``round_plan``): configurations are read off the same dynamic program and each is
  taken as often as the whole remaining demand allows. Best-fit decreasing completes the last
  part, from the point at which that gives the fewest bins.

Every step works on counts, so planning takes the same time at any size, on the driver. The
pieces never pass through it: each finds its place from its rank among the pieces of its
length, which comes from counters inside each task and the counts of the tasks before it.

NULL text counts as empty: one piece with the end id alone. NULL ids stay NULL. Repeated rows
are packed as often as they occur. An empty table gives an empty result. Other columns of the
input documents are not looked at; those of the pieces are carried along.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallyloom import store
from tallyloom.llm import common
from tallyloom.llm.tokens import word_tokens

CAPACITY = 2048
ROUNDS = 60
RATE = 0.3
EPSILON = 0.02
TAILS = (0.5, 0.25, 0.1, 0.05, 0.02, 0.01)
Plan = list[tuple[dict[int, int], int]]


def pieces(docs: DataFrame, vocabulary: str, end: int, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids: every document's ids and the end id, cut to size.

    ``ids`` holds them as little-endian unsigned 32-bit numbers. The columns of ``RANKED`` come
    with them, as the pieces are counted where they are made, not in a second Python step.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen = word_tokens(vocabulary), TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            rows, size = [], 0
            for doc_id, found in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1))):
                ids = np.append(found, np.uint32(end)).astype("<u4")
                for number, start in enumerate(range(0, len(ids), capacity)):
                    rows.append((doc_id, number, start, ids[start : start + capacity]))
                size += len(ids)
                if size > 1_000_000:
                    yield _with_ranks(_pieces(rows), part, seen)
                    rows, size = [], 0
            yield _with_ranks(_pieces(rows), part, seen)

    schema = "doc_id long, piece int, start long, length long, ids binary, _part long, _rank long"
    return common.take(docs, "doc_id", "text").mapInArrow(cut, schema)


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    doc_id, piece, start, ids = zip(*rows) if rows else ((), (), (), ())
    length = [len(x) for x in ids]
    columns = {
        "doc_id": pa.array(doc_id, pa.int64()),
        "piece": pa.array(piece, pa.int32()),
        "start": pa.array(start, pa.int64()),
        "length": pa.array(length, pa.int64()),
        "ids": pa.array([x.tobytes() for x in ids], pa.binary()),
    }
    return pa.RecordBatch.from_pydict(columns)


def knapsack(price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Highest price of lengths that fit into each space, and the length to take first.

    ``price`` is indexed by length; 0 marks lengths that are not there. Ties take the longest.
    """
    lengths = np.flatnonzero(price > 0)[::-1]
    best, first = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for space in range(1, capacity + 1):
        best[space] = best[space - 1]
        fitting = lengths[np.searchsorted(-lengths, -space) :]
        if len(fitting):
            worth = best[space - fitting] + price[fitting]
            i = int(worth.argmax())
            if worth[i] > best[space] + 1e-12:
                best[space], first[space] = worth[i], fitting[i]
    return best, first


def weights(demand: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """Weights of the lengths and the lower bound on the number of bins that they prove."""
    lengths = np.flatnonzero(demand)
    weight = np.zeros(capacity + 1)
    weight[lengths] = lengths / capacity
    kept, bound = weight.copy(), 0.0
    for step in range(ROUNDS):
        best, first = knapsack(weight, capacity)
        value = weight[lengths] + best[capacity - lengths]
        now = float((demand * weight).sum() / value.max())
        if now > bound + 1e-9:
            kept, bound = weight / value.max(), now
        held = lengths[value >= (1 - EPSILON) * value.max()]
        played = demand[held] * (now / demand[held].sum())
        covered = np.zeros(capacity + 1)
        covered[held] = played
        space = capacity - held
        while space.any():
            taken = first[space]
            used = taken > 0
            np.add.at(covered, taken[used], played[used])
            space = np.where(used, space - taken, np.maximum(space - 1, 0))
        excess = np.clip(covered[lengths] / demand[lengths] - 1, -1, 2)
        weight[lengths] *= np.exp(-RATE * excess / (1 + step / 20))
    return kept, bound


def best_fit(demand: np.ndarray, capacity: int) -> Plan:
    """Best-fit decreasing over counts; equal bins are handled together."""
    bins: dict[int, list[tuple[Counter, int]]] = defaultdict(list)
    for length in np.flatnonzero(demand)[::-1].tolist():
        left = int(demand[length])
        while left:
            space = min((s for s, held in bins.items() if s >= length and held), default=None)
            if space is None:
                each = min(left, capacity // length)
                content, count, space = Counter({length: each}), left // each, capacity
                bins[space - each * length].append((content, count))
                left -= each * count
                continue
            content, count = bins[space].pop()
            moved = min(left, count)
            if moved < count:
                bins[space].append((content, count - moved))
            bins[space - length].append((content + Counter({length: 1}), moved))
            left -= moved
    return [(dict(content), count) for held in bins.values() for content, count in held]


def round_plan(demand: np.ndarray, weight: np.ndarray, capacity: int) -> Plan:
    left = demand.copy()
    total = int((left * np.arange(capacity + 1)).sum())
    tails = [total * share for share in TAILS]
    best, _ = knapsack(np.where(left > 0, weight, 0), capacity)
    plan: Plan = []
    ways: list[tuple[int, int, Plan]] = []  # bins, how much of the plan stays, its last part
    used_up = False
    while left.any():
        lengths = np.flatnonzero(left)[::-1]
        content, value = _configuration(left, lengths, weight, best, capacity)
        longest = int(lengths[0])
        if used_up and value < weight[longest] + best[capacity - longest] - 1e-9:
            best, _ = knapsack(np.where(left > 0, weight, 0), capacity)
            used_up = False
            continue
        times = min(int(left[n]) // m for n, m in content.items())
        for n, m in content.items():
            left[n] -= m * times
            total -= n * m * times
            used_up |= left[n] == 0
        plan.append((content, times))
        while tails and total <= tails[0]:
            tails.pop(0)
            tail = best_fit(left, capacity)
            ways.append((sum(t for _, t in plan + tail), len(plan), tail))
    ways.append((sum(t for _, t in plan), len(plan), []))
    _, kept, tail = min(ways, key=lambda way: way[:2])
    return plan[:kept] + tail


def _configuration(left, lengths, weight, best, capacity) -> tuple[dict[int, int], float]:
    """The longest length and the best filling that the remaining demand still holds."""
    free, space, content = left.copy(), capacity, Counter()
    value, taken = 0.0, int(lengths[0])
    while True:
        content[taken] += 1
        free[taken] -= 1
        space -= taken
        value += weight[taken]
        fitting = lengths[(lengths <= space) & (free[lengths] > 0)]
        if not len(fitting):
            return dict(content), value
        taken = int(fitting[(best[space - fitting] + weight[fitting]).argmax()])


def plan(demand: np.ndarray, capacity: int) -> Plan:
    """Configurations and how often each is used; their sum covers ``demand`` exactly."""
    if not demand.any():
        return []
    weight, _ = weights(demand, capacity)
    return round_plan(demand, weight, capacity)


RANK_BITS = 40


@dataclass
class Places:
    """Where the r-th piece of a length goes: one entry per configuration and length in it."""

    key: np.ndarray  # length and first rank
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, plan: Plan) -> Places:
        rows, used, sequence = [], Counter(), 0
        for content, times in plan:
            offset = 0
            for length, each in content.items():
                rows.append(((length << RANK_BITS) + used[length], sequence, each, offset))
                used[length] += each * times
                offset += each * length
            sequence += times
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        return cls(*table.T)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (length << RANK_BITS) + rank
        at = np.searchsorted(self.key, key, "right") - 1
        after = key - self.key[at]
        each = self.each[at]
        return self.sequence[at] + after // each, self.offset[at] + after % each * length


RANKED = ["_part", "_rank"]


def _with_ranks(batch: pa.RecordBatch, part: int, seen: dict[int, int]) -> pa.RecordBatch:
    """Adds the task's number and the rank among the task's pieces of the same length."""
    ranks = []
    for length in batch.column("length").to_pylist():
        ranks.append(seen[length])
        seen[length] += 1
    extra = [pa.array([part] * len(ranks), pa.int64()), pa.array(ranks, pa.int64())]
    return pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, *RANKED])


def ranked(found: DataFrame) -> DataFrame:
    """``found`` with the columns of ``RANKED``, for pieces that do not come from ``pieces``."""

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            yield _with_ranks(batch, part, seen)

    added = [StructField(name, LongType()) for name in RANKED]
    return found.mapInArrow(rank, StructType(found.schema.fields + added))


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``found`` (it has a ``length`` from 1 to ``capacity``) with their places.

    ``sequence_id`` numbers the sequences from 0; ``offset`` is the place in the sequence,
    which pieces fill without gaps.
    """
    counted = found if found.columns[-2:] == RANKED else ranked(found)
    columns = counted.columns[:-2]
    rows = store.materialise(counted, "pieces")
    counts = store.materialise(rows.groupBy("length", "_part").count(), "piece-counts")
    demand = np.zeros(capacity + 1, np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("count")).collect():
        demand[length] = n
    places = Places.of(plan(demand, capacity))
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        "length", "_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before")
    )
    placed = rows.join(before, ["length", "_part"]).withColumn("_rank", F.col("_before") + F.col("_rank"))
    placed = placed.select(*columns, "_rank")
    length_at = columns.index("length")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (length_at, batch.num_columns - 1))
            columns = [*batch.columns[:-1], *map(pa.array, places.find(length, rank))]
            names = [*batch.schema.names[:-1], "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(columns, names)

    added = [StructField("sequence_id", LongType()), StructField("offset", LongType())]
    fields = [rows.schema[name] for name in columns]
    return placed.mapInArrow(place, StructType(fields + added))
