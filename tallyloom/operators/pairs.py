"""Joining a user's rows with the same user's rows, safely for very active users.

A user with ``d`` rows brings ``d²`` matches under one join key, which no shuffle can split.
AQE's skew join looks at bytes and does not see this: a few hundred megabytes can hold one
user with 10¹² matches. Here such a user's items are hashed into ``b = ceil(d / block)``
blocks and the join key becomes (user, left block, right block). A row is copied ``b`` times,
each match happens in exactly one cell, and a cell has about ``block²`` matches. All partners
are kept; users below the limit, usually all of them, are joined as they are.

Sums over pairs of items go another way (``matches_by_cell``): matches are many times the rows and
meet almost as many different pairs in each task, so partial sums hardly shrink them. There the
*items* are hashed into ``tiles`` blocks, a cell is a pair of blocks, and a user's lists of both go
to it. All matches of two items are in one cell, so their sums are whole in the task that makes them
(``sums_by_cell``), and what is shuffled is each row at most ``tiles`` times. As no list is longer than
its block, active users are spread by the same means.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom import store

# Workers get this module's functions themselves and need not find the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_SIZE = 1024
MATCHES_PER_TASK = 20_000_000
MAX_PARTITIONS = 200_000
#: Matches in a cell of two blocks of items, and the rows of one user in one block, about.
MATCHES_PER_CELL = 160_000_000
ROWS_PER_LIST = 8192
#: Matches that a task of ``sums_by_cell`` makes at a time.
MATCHES_AT_ONCE = 1_000_000


@dataclass(frozen=True)
class UserLoad:
    """How to join a user's rows with each other.

    ``active`` is ``(user_id, blocks)`` for the users to cut up, or None when there are none.
    ``partitions`` follows the number of matches and not the size of the input, which says
    little about a join that multiplies its rows. ``tiles`` is the number of blocks of items.
    """

    active: DataFrame | None
    partitions: int
    tiles: int = 1


def user_load(ratings: DataFrame, block: int = BLOCK_SIZE) -> UserLoad:
    """Action: one count per user, reduced to one row; a second pass only when a user has
    more than ``block`` rows."""
    spark = ratings.sparkSession
    counts = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n").cast("double")
    total = counts.agg(F.max("n").alias("most"), F.sum(n * n).alias("matches")).first()
    partitions = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        spark.sparkContext.defaultParallelism,
        min(MAX_PARTITIONS, math.ceil((total["matches"] or 0) / MATCHES_PER_TASK)),
    )
    tiles = math.ceil(
        max(
            math.sqrt(4 * spark.sparkContext.defaultParallelism),  # two cells a core
            math.sqrt((total["matches"] or 0) / MATCHES_PER_CELL),
            (total["most"] or 0) / ROWS_PER_LIST,
        )
    )
    if (total["most"] or 0) <= block:
        return UserLoad(None, partitions, tiles)
    active = counts.filter(F.col("n") > block).select(
        "user_id", F.ceil(F.col("n") / F.lit(block)).cast("int").alias("blocks")
    )
    return UserLoad(store.materialise(active, "active-users"), partitions, tiles)


def _cells(df: DataFrame, item: str, users: DataFrame, own: str, other: str) -> DataFrame:
    blocks = F.coalesce(F.col("blocks"), F.lit(1))
    return (
        df.join(users, "user_id", "left")
        .withColumns(
            {
                own: F.pmod(F.xxhash64(item), blocks).cast("int"),
                other: F.explode(F.sequence(F.lit(0), blocks - 1)),
            }
        )
        .drop("blocks")
    )


def join_by_user(
    left: DataFrame,
    right: DataFrame,
    left_item: str,
    right_item: str,
    load: UserLoad,
    condition: Column | None = None,
) -> DataFrame:
    """Inner join on ``user_id``; both sides must name their other columns differently."""
    keys = ["user_id"]
    if load.active is not None:
        left = _cells(left, left_item, load.active, "left_block", "right_block")
        right = _cells(right, right_item, load.active, "right_block", "left_block")
        keys += ["left_block", "right_block"]
    # A fixed number, because AQE would merge partitions whose input looks small.
    left, right = left.repartition(load.partitions, *keys), right.repartition(load.partitions, *keys)
    joined = left.join(right, keys).drop("left_block", "right_block")
    return joined if condition is None else joined.filter(condition)


def _cells_of_lists(rows: DataFrame, item: str, value: str, load: UserLoad) -> DataFrame:
    """``(cell, a, b)``: a user's lists ``(block, ids, values)`` of two blocks of items, partitioned by
    cell. ``b`` is NULL where a block meets itself."""
    block = F.pmod(F.xxhash64(item), F.lit(load.tiles)).cast("int")
    known = rows.where(F.col("user_id").isNotNull() & F.col(item).isNotNull())
    lists = (
        known.select("user_id", block.alias("block"), F.struct(F.col(item).alias("id"), F.col(value).alias("value")).alias("e"))
        .repartition("user_id")
        .groupBy("user_id", "block")
        .agg(F.collect_list("e").alias("e"))
        .select("user_id", F.struct("block", F.col("e")["id"].alias("ids"), F.col("e")["value"].alias("values")).alias("list"))
        .groupBy("user_id")
        .agg(F.array_sort(F.collect_list("list")).alias("lists"))
    )
    first = lists.select("lists", F.posexplode("lists").alias("place", "a"))
    both = first.select("a", F.explode(F.slice("lists", F.col("place") + 1, F.size("lists"))).alias("b"))
    # Numbered without gaps, as a's block is not behind b's: one cell a task.
    cell = F.expr("CAST(b.block * (b.block + 1L) DIV 2 + a.block AS INT)")
    tasks = min(MAX_PARTITIONS, load.tiles * (load.tiles + 1) // 2)
    # A block that meets itself is sent once.
    other = F.when(F.col("a")["block"] != F.col("b")["block"], F.col("b"))
    return both.select(cell.alias("cell"), "a", other.alias("b")).repartitionById(tasks, "cell")


def matches_by_cell(rows: DataFrame, item: str, value: str, load: UserLoad) -> DataFrame:
    """``(cell, a, b)``: each two rows of a user with different items, once, as structs ``(id, value)``.

    Rows are partitioned by cell and all matches of two items have one cell, so grouping by cell and
    both ids needs no shuffle. Which of the two is ``a`` is the same for all matches of two items.
    """
    cells = _cells_of_lists(rows, item, value, load)

    def entries(side: Column) -> Column:
        return F.arrays_zip(side["ids"].alias("id"), side["values"].alias("value"))

    a, b = F.col("a"), F.coalesce("b", "a")
    opened = cells.select("cell", F.isnull("b").alias("same"), entries(a).alias("of_a"), entries(b).alias("of_b"))
    opened = opened.select("cell", "same", "of_b", F.explode("of_a").alias("a"))
    opened = opened.select("cell", "same", "a", F.explode("of_b").alias("b"))
    return opened.where(~F.col("same") | (F.col("a")["id"] < F.col("b")["id"])).drop("same")


def sums_by_cell(rows: DataFrame, item: str, value: str, load: UserLoad) -> DataFrame:
    """``(a, b, xy, xx, yy, support)``: sums over the matches of two items and their number.

    What grouping ``matches_by_cell`` gives, with numpy: a task makes ``MATCHES_AT_ONCE`` matches at a
    time and merges their sums into those of all its pairs, 40 bytes each. Spark's hash aggregation takes
    three times that, and where a cell's pairs are more than it holds, it writes out most matches.
    Item ids are whole numbers. NULL values count as matches and add nothing.
    """
    cells = _cells_of_lists(rows, item, value, load)

    def entries(side: str) -> list[Column]:
        kinds = (("ids", "array<bigint>"), ("values", "array<double>"))
        return [F.col(side)[c].cast(kind).alias(f"{side}_{c}") for c, kind in kinds]

    lists = cells.select(*entries("a"), *entries("b"))
    kind = rows.schema[item].dataType
    summed = lists.mapInArrow(_summed, "a long, b long, xy double, xx double, yy double, support long")
    return summed.withColumns({c: F.col(c).cast(kind) for c in ("a", "b")})


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # No two cells share a pair of items, so a task need not tell its cells apart.
    codes, sums = _Codes(), _Sums()
    for batch in batches:
        ids, values, begin = _flat(batch.column(0), batch.column(1))
        code = codes.of(ids)
        other = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
        b_ids, b_values, b_begin = _flat(batch.column(2), batch.column(3))
        # Behind one another, so that a block that meets itself finds its partners among its own.
        to_code, to_value = np.concatenate([code, codes.of(b_ids)]), np.concatenate([values, b_values])
        to_begin = np.where(other, len(ids) + b_begin[:-1], begin[:-1])
        many = np.where(other, np.diff(b_begin), np.diff(begin))
        row = np.repeat(np.arange(len(many)), np.diff(begin))
        partners = many[row]
        ends = np.cumsum(partners)
        at = 0
        while at < len(row):
            done = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + MATCHES_AT_ONCE, "right")))
            n = partners[at:stop]
            left = np.repeat(np.arange(at, stop), n)
            right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(to_begin[row[at:stop]], n)
            same = ~other[row[left]]
            if same.any():
                kept = ~same | (codes.ids(code[left]) < codes.ids(to_code[right]))
                left, right = left[kept], right[kept]
            x, y = values[left], to_value[right]
            with np.errstate(all="ignore"):
                sums.add(code[left] << 32 | to_code[right], x * y, x * x, y * y, np.ones(len(x), np.int64))
            at = stop
    key, *found = sums.all()
    for start in range(0, len(key), 100_000):
        some = slice(start, start + 100_000)
        columns = [codes.ids(key[some] >> 32), codes.ids(key[some] & 0xFFFFFFFF), *(c[some] for c in found)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "xy", "xx", "yy", "support"])


def _flat(ids: pa.ListArray, values: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, values with 0 for NULL, and where each list begins; a NULL list is an empty one."""
    size = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    begin = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    return ids.flatten().to_numpy(), pc.fill_null(values.flatten(), 0.0).to_numpy(zero_copy_only=False), begin


class _Codes:
    """Numbers for ids in the order in which they come."""

    def __init__(self):
        self.known, self.code, self.listed = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def of(self, ids: np.ndarray) -> np.ndarray:
        new = np.setdiff1d(ids, self.known)
        if len(new):
            known = np.concatenate([self.known, new])
            order = np.argsort(known, kind="stable")
            code = np.concatenate([self.code, len(self.listed) + np.arange(len(new))])
            self.known, self.code, self.listed = known[order], code[order], np.concatenate([self.listed, new])
        return self.code[np.searchsorted(self.known, ids)]

    def ids(self, code: np.ndarray) -> np.ndarray:
        return self.listed[code]


class _Sums:
    """Columns of sums by key. What comes is merged when it has grown as long as what is there."""

    def __init__(self):
        self.whole, self.parts, self.waiting = None, [], 0

    def add(self, key: np.ndarray, *columns: np.ndarray) -> None:
        self.parts.append(_by_key(key, columns))
        self.waiting += len(self.parts[-1][0])
        if self.waiting > max(MATCHES_AT_ONCE, 0 if self.whole is None else len(self.whole[0])):
            self.whole, self.parts, self.waiting = self.all(), [], 0

    def all(self) -> list[np.ndarray]:
        parts = self.parts if self.whole is None else [self.whole, *self.parts]
        if not parts:
            return [np.empty(0, np.int64), *(np.empty(0) for _ in range(3)), np.empty(0, np.int64)]
        return parts[0] if len(parts) == 1 else _by_key(np.concatenate([p[0] for p in parts]), [np.concatenate(c) for c in zip(*(p[1:] for p in parts))])


def _by_key(key: np.ndarray, columns: Sequence[np.ndarray]) -> list[np.ndarray]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
    if not len(first):
        return [key, *columns]
    return [key[first], *(np.add.reduceat(c[order], first) for c in columns)]
