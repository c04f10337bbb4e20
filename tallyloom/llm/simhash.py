"""Near-duplicates by SimHash, every pair of fingerprints within a bit distance.

*Fingerprints.* A-Z are lower-cased, words are runs without ASCII white space, and each
shingle of ``words`` words in a row (repeats included; the whole sequence where there are
fewer) is hashed with XXH64, seed 42. A bit of the fingerprint is 1 where more than half of
the hashes have it. Texts without a word, NULL and empty ones, have fingerprint 0 and are
linked like any other.

*Candidates.* Equal fingerprints are one node. The 64 bits are cut into ``radius + 2`` parts;
two fingerprints within the radius agree in at least two parts, so they meet in one of the
tables that hold the nodes by two of the parts. No pair is lost. A bucket of more than
``BUCKET`` nodes is cut into blocks by hash and every pair of its blocks is compared.

*Comparison.* Nodes are stored as bit planes: word w of plane b holds bit b of 64 nodes. A
comparison XORs planes, 64 pairs a step, and adds the result to counters that are themselves
bit planes, carry-save, so that all distances grow together. Words whose 64 pairs all exceed
the radius are abandoned. Within a bucket only links that join parts are given, at most one
less than it has nodes, never all pairs.

*Groups.* Components of the links are found on tables (``components``).

NULL ids are in no way special but that they never name a component that has another id; a
component of NULL ids alone has a NULL ``component_id``. Repeated rows stay. An empty table
gives an empty result. Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallyloom import store
from tallyloom.llm import common
from tallyloom.llm.components import components

WORDS = 3
RADIUS = 3
SEED = 42
BITS = 64
BUCKET = 4096
SMALL = 64
ROWS = 50_000
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Unsigned 64-bit SimHash of one text."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    last = np.cumsum([len(p) + 1 for p in parts]) - 1
    first = np.concatenate([[0], last[:-1] + 1])
    size = min(words, len(parts))
    spans = zip(first[: len(parts) - size + 1].tolist(), last[size - 1 :].tolist())
    hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], ">u8")
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), ROWS):
        some = hashes[i : i + ROWS]
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes())


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, fp: the fingerprint's bits as a signed number."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return common.take(docs, "doc_id", "text").mapInArrow(hashed, "doc_id long, fp long")


def planes(fps: np.ndarray) -> np.ndarray:
    """64 rows of words; bit i of word w in row b is bit b of fingerprint 64 w + i."""
    count = -(-len(fps) // 64) * 64
    padded = np.zeros(count, "<u8")
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(count, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def pack_mask(flags: np.ndarray) -> np.ndarray:
    padded = np.zeros(-(-len(flags) // 64) * 64, bool)
    padded[: len(flags)] = flags
    return np.packbits(padded, bitorder="little").view("<u8")


def unpack_mask(words: np.ndarray) -> np.ndarray:
    return np.unpackbits(words.view(np.uint8), bitorder="little").view(bool)


def within(
    diff: Callable[[int, np.ndarray], np.ndarray], open_pairs: np.ndarray, radius: int
) -> np.ndarray:
    """Which of ``open_pairs`` (a mask in words) differ in at most ``radius`` planes.

    ``diff(b, active)`` gives, for the words at ``active``, where the pairs differ in plane b.
    The counters start so that they overflow with the first difference too many.
    """
    near = np.zeros_like(open_pairs)
    active = np.flatnonzero(open_pairs)
    over = ~open_pairs[active]
    digits = radius.bit_length()
    start = (1 << digits) - 1 - radius
    counters = [np.full(len(active), ALL if start >> j & 1 else 0, np.uint64) for j in range(digits)]
    for plane in range(BITS):
        carry = diff(plane, active)
        for digit in counters:
            more = digit & carry
            digit ^= carry
            carry = more
        over |= carry
        if plane % 8 == 7:
            alive = over != ALL
            active, over = active[alive], over[alive]
            counters = [digit[alive] for digit in counters]
            if not len(active):
                return near
    near[active] = ~over
    return near


def small_links(fps: np.ndarray, place: np.ndarray, size: np.ndarray, radius: int):
    """Links inside buckets of at most 64 nodes, all buckets at once.

    Row i is the ``place``-th of a bucket of ``size`` rows. A step compares each row with the
    one ``step`` rows further. Buckets come with the largest first, so that the rows which
    have such a partner are at the front.
    """
    found_a, found_b = [], []
    bits = planes(fps)
    shifted = np.concatenate([bits, np.zeros((BITS, 1), np.uint64)], axis=1)
    for step in range(1, int(size.max(initial=0))):
        rows = int((size > step).sum())
        words = -(-rows // 64)
        low, high = np.uint64(step), np.uint64(64 - step)
        other = (shifted[:, :words] >> low) | (shifted[:, 1 : words + 1] << high)
        open_pairs = pack_mask((place + step < size)[:rows])
        near = within(lambda b, at: bits[b, at] ^ other[b, at], open_pairs, radius)
        first = np.flatnonzero(unpack_mask(near))
        found_a.append(first)
        found_b.append(first + step)
    return np.concatenate([[], *found_a]).astype(int), np.concatenate([[], *found_b]).astype(int)


def forest(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row that each of ``count`` rows is linked with, directly or over others."""
    label = np.arange(count)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before, label)
        label = label[label]
        if (label == before).all():
            return label


def large_labels(fps: np.ndarray, radius: int) -> np.ndarray:
    """The same for one bucket: rows reached from a row are compared with those not reached."""
    count = len(fps)
    bits = planes(fps)
    values = [np.where(fps >> np.uint64(b) & np.uint64(1), ALL, np.uint64(0)) for b in range(BITS)]
    label = np.arange(count)
    unseen = np.ones(count, bool)
    while unseen.any():
        seed = int(unseen.argmax())
        unseen[seed] = False
        waiting = [seed]
        while waiting:
            asked, waiting = np.array(waiting[:64]), waiting[64:]
            rest = pack_mask(unseen)
            words = len(rest)

            def diff(b: int, at: np.ndarray) -> np.ndarray:
                return bits[b, at % words] ^ values[b][asked[at // words]]

            near = within(diff, np.tile(rest, len(asked)), radius).reshape(len(asked), words)
            reached = np.flatnonzero(unpack_mask(np.bitwise_or.reduce(near, axis=0))[:count])
            label[reached] = seed
            unseen[reached] = False
            waiting += reached.tolist()
    return label


def bucket_links(bucket: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is joined within each bucket; ``bucket`` numbers are in order."""
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    size = np.diff(np.append(starts, len(bucket)))
    label = np.arange(len(bucket))
    for start, rows in zip(starts[size > SMALL].tolist(), size[size > SMALL].tolist()):
        label[start : start + rows] = start + large_labels(fps[start : start + rows], radius)
    starts, size = starts[size <= SMALL], size[size <= SMALL]
    order = np.argsort(-size, kind="stable")
    starts, size = starts[order], size[order]
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    row = np.repeat(starts, size) + place
    a, b = small_links(fps[row], place, np.repeat(size, size), radius)
    label[row] = row[forest(len(row), a, b)]
    linked = np.flatnonzero(label != np.arange(len(label)))
    return fps[label[linked]], fps[linked]


def _masks(radius: int) -> list[int]:
    """Signed masks of the bits by which each table is kept."""
    edges = [BITS * i // (radius + 2) for i in range(radius + 3)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    joined = [a | b for a, b in combinations(parts, 2)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in joined]


def links(nodes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """u, v: links that join all fingerprints ``fp`` within ``radius`` of each other."""
    tables = F.array(*(F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in _masks(radius)))
    placed = nodes.select("fp", F.posexplode(tables).alias("table", "key"))
    held = store.materialise(placed.groupBy("table", "key").count().where("count > 1"), "buckets")
    blocks = F.ceil(F.col("count") / bucket)
    mine = F.pmod(F.xxhash64("fp"), blocks)
    others = F.filter(F.sequence(F.lit(0), blocks - 1), lambda o: (o != F.col("mine")) | (F.col("blocks") == 1))
    rows = placed.join(held, ["table", "key"]).withColumns({"blocks": blocks, "mine": mine})
    rows = rows.withColumn("other", F.explode(others))
    low, high = F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high")
    groups = ["table", "key", "low", "high"]
    rows = rows.select("table", "key", low, high, "fp").repartition(*groups).sortWithinPartitions(*groups)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            kept.append(batch)
            if sum(map(len, kept)) >= ROWS:
                whole, rest = _whole_groups(pa.Table.from_batches(kept), len(groups))
                kept = rest.to_batches()
                yield _linked(whole, radius, len(groups))
        if kept:
            yield _linked(pa.Table.from_batches(kept), radius, len(groups))

    return rows.mapInArrow(compare, "u long, v long")


def _changes(rows: pa.Table, keys: int) -> np.ndarray:
    """Where a row's group differs from that of the row before."""
    new = np.zeros(max(0, len(rows) - 1), bool)
    for i in range(keys):
        values = rows.column(i).to_numpy()
        new |= values[1:] != values[:-1]
    return new


def _whole_groups(rows: pa.Table, keys: int) -> tuple[pa.Table, pa.Table]:
    """All groups but the last, which may go on, and the last."""
    new = np.flatnonzero(_changes(rows, keys))
    cut = int(new[-1]) + 1 if len(new) else 0
    return rows.slice(0, cut), rows.slice(cut)


def _linked(rows: pa.Table, radius: int, keys: int) -> pa.RecordBatch:
    group = np.concatenate([[0], np.cumsum(_changes(rows, keys))])[: len(rows)]
    a, b = bucket_links(group, rows.column(keys).to_numpy().view(np.uint64), radius)
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["u", "v"])


def _grouped(found: DataFrame, radius: int) -> DataFrame:
    """fp, root (the fingerprint that names the group) and component_id for the (doc_id, fp) given."""
    nodes = store.materialise(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    rooted = components(links(nodes, radius)).select(F.col("node").alias("fp"), "root")
    member = nodes.join(rooted, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    member = store.materialise(member, "members")
    named = store.materialise(member.groupBy("root").agg(F.min("first").alias("component_id")), "components")
    return store.materialise(member.join(named, "root").select("fp", "root", "component_id"), "groups")


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id (smallest id of its group)."""
    found = store.materialise(fingerprints(docs, words), "fingerprints")
    return found.join(_grouped(found, radius), "fp").select("doc_id", "fp", "component_id")


def keep(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: the smallest id of each group.

    Where ids are NULL or repeated the smallest fingerprint decides, and then any one row.
    """
    rows, (doc_id, text) = common.plain(docs, "doc_id", "text")
    at = rows.columns.index(text)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), words) for t in batch.column(at)], np.uint64)
            columns = [*batch.columns, pa.array(fps.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "fp"])

    schema = StructType([*rows.schema.fields, StructField("fp", LongType())])
    rows = store.materialise(rows.mapInArrow(hashed, schema), "fingerprinted")
    found = rows.select(F.col(doc_id).alias("doc_id"), "fp")
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp")).alias("best")
    stays = found.join(_grouped(found, radius), "fp").groupBy("root").agg(best)
    stays = store.materialise(stays.select("best.doc_id", F.col("best.fp").alias("fp_kept")), "near-kept")
    same = (rows["fp"] == stays["fp_kept"]) & rows[doc_id].eqNullSafe(stays["doc_id"])
    repeats = Window.partitionBy(doc_id, "fp").orderBy(F.lit(0))
    kept = rows.join(stays, same, "left_semi").withColumn("copy", F.row_number().over(repeats))
    return common.named(kept.where("copy = 1"), docs)


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
