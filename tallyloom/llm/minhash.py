"""Near-duplicates by HyperMinHash: documents whose shingle sets have Jaccard similarity of at least
``LEAST`` per cent.

*Sets.* A-Z are lower-cased, words are runs without ASCII white space, and a document's set is that
of its shingles of ``words`` words in a row (the whole sequence where there are fewer). Shingles
are told apart by 64-bit hashes. Documents with equal sets, by a 128-bit digest of the whole set, are
one node.

*Sketch.* The first bits of a shingle's hash choose one of ``BUCKETS`` buckets. Of the smallest hash
in a bucket the register keeps the number of leading zeros and the ``MANTISSA`` bits after the
first one: two bytes a bucket. An empty bucket has register 0; for banding it borrows the register
of the first bucket with one, in a random order of its own.

*Banding.* ``BANDS`` bands of ``ROWS`` registers; nodes with an equal band are compared. A pair at
exactly 0.8 has no equal band in 2 of 10^9 cases.

*Estimate.* The share of equal registers among the buckets that either node fills, corrected for
registers that are equal by accident (compressed ones are, at a rate that depends on both sizes).
The buckets' smallest hashes are a sample, without replacement, of the union of both sets. Pairs are
left out only where the estimate is ``DEVIATIONS`` standard deviations of such a sample below the
limit.

*Verification* counts the intersection of the full sets.

*Order of work.* First each node of a band's bucket is compared with the smallest one there, and links
found join nodes into components; so a group of copies costs one comparison a copy. What is left to
compare are nodes of different components in one bucket. Buckets of at most ``FEW`` nodes give these
pairs as rows. Larger ones, which hold a group of like texts, are put together by their largest
component, and each node outside it is compared with all others of the group, in
cells of ``BLOCK`` nodes and ``ASKED`` questions, whose tasks hold the full sets: they give links, at
most one a question and component, and no pairs. No link is left out.

Texts without a word, NULL and empty ones, have an empty set, ``n_shingles`` 0, and are a component
each; if such rows repeat an id they share it. NULL ids never name a component that has another id;
a component of NULL ids alone has a NULL ``component_id``. Repeated rows stay. Whole texts are read,
in time that grows with their length. An empty table gives an empty result. Other columns of the
input are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyloom import store
from tallyloom.llm import common
from tallyloom.llm.components import components

WORDS = 2
LEAST = 80
BUCKETS = 256
MANTISSA = 10
ROWS = 5
BANDS = BUCKETS // ROWS
DEVIATIONS = 5
FEW = 64
BLOCK, ASKED = 1024, 256
PAIRS = 256
KNOWN, KNOWN_BYTES = 100_000, 48
BUFFER_BYTES = 16_000_000
FEWEST_BITS, MOST_BITS = 1 << 20, 1 << 26
_BUCKET_BITS = BUCKETS.bit_length() - 1
#: Chance that two registers of one bucket are equal though their hashes are not, for sets of equal
#: size times 4: the mean width of a register's cell against its place, 1 / (2 ln 2).
ACCIDENT = 1 / (2 * np.log(2)) / (1 << MANTISSA)


def _orders() -> np.ndarray:
    """For every bucket all buckets in a fixed random order, itself first."""
    rng = np.random.default_rng(42)
    rows = np.array([rng.permutation(BUCKETS) for _ in range(BUCKETS)])
    for i, row in enumerate(rows):
        row[row == i], row[0] = row[0], i
    return rows


ORDERS = _orders()


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit, and no two inputs meet."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Hashes of words; those of short ones are kept, up to ``KNOWN``, and looked up later."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.known: dict[bytes, int] = {}

    def _hashes(self, parts: list[bytes]) -> np.ndarray:
        found = list(map(self.known.get, parts))
        if None in found:
            new = {p: xxhash.xxh64_intdigest(p) for p, h in zip(parts, found) if h is None}
            found = [new[p] if h is None else h for p, h in zip(parts, found)]
            if len(self.known) < KNOWN:
                self.known.update((p, h) for p, h in new.items() if len(p) <= KNOWN_BYTES)
        return np.array(found, np.uint64)

    def of(self, text: str | None) -> np.ndarray:
        """The set of the text: its shingles' hashes, in order, each once."""
        parts = (text or "").encode().lower().split()
        if not parts:
            return np.empty(0, np.uint64)
        size = min(self.words, len(parts))
        one = self._hashes(parts)
        joined = np.full(len(parts) - size + 1, size, np.uint64)
        for i in range(size):
            joined = mixed(joined * np.uint64(0x9E3779B97F4A7C15) + one[i : i + len(joined)])
        return np.unique(joined)


def digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.astype("<u8").tobytes(), digest_size=16).digest()


def registers(found: np.ndarray) -> np.ndarray:
    """The sketch of a set, given as hashes in order."""
    out = np.zeros(BUCKETS, np.uint16)
    bucket = (found >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(found) else []
    rest = found[first] << np.uint64(_BUCKET_BITS)  # hashes are in order, so each is its bucket's smallest
    zeros = np.zeros(len(rest), np.uint64)
    for step in (32, 16, 8, 4, 2, 1):
        empty = (rest >> np.uint64(64 - step)) == 0
        zeros[empty] += np.uint64(step)
        rest = np.where(empty, rest << np.uint64(step), rest)
    zeros = np.minimum(zeros, np.uint64(62))  # 0 marks an empty bucket, 63 a hash of zeros alone
    after = (rest << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    out[bucket[first]] = ((zeros + np.uint64(1)) << np.uint64(MANTISSA) | after).astype(np.uint16)
    return out


def bands(sketch: np.ndarray) -> np.ndarray:
    """One key a band, as signed numbers; none for an empty set."""
    if not sketch.any():
        return np.empty(0, np.int64)
    filled = sketch
    if not sketch.all():
        filled = sketch[ORDERS[np.arange(BUCKETS), (sketch != 0)[ORDERS].argmax(axis=1)]]
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in filled[: BANDS * ROWS].reshape(BANDS, ROWS).T:
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys.view(np.int64)


def likely(sketches: np.ndarray, sizes: np.ndarray, sketch: np.ndarray, size) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarities, and which are not surely below the limit."""
    either = ((sketches != 0) | (sketch != 0)).sum(axis=1)  # of one node or of one for each row
    equal = ((sketches == sketch) & (sketch != 0)).sum(axis=1)
    accident = ACCIDENT * sizes * size / (sizes + size) ** 2
    estimate = (equal / np.maximum(either, 1) - accident) / (1 - accident)
    least = LEAST / 100
    union = np.maximum((sizes + size) / (1 + least), either + 1)  # at the limit
    spread = least * (1 - least) / np.maximum(either, 1) * (union - either) / (union - 1)
    slack = DEVIATIONS * np.sqrt(spread) + 1 / np.maximum(either, 1)
    low, high = np.minimum(sizes, size), np.maximum(sizes, size)
    return estimate, (estimate >= least - slack) & (100 * low >= LEAST * high)


def sketched(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, digest of the set, sketch and keys of every document."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in batches:
            sizes, nodes, sketches, keys = [], [], [], []
            for text in batch.column(1):
                found = shingles.of(text.as_py())
                sketch = registers(found)
                sizes.append(len(found))
                nodes.append(digest(found))
                sketches.append(sketch.tobytes())
                keys.append(bands(sketch))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.array(sketches, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "digest", "sketch", "keys"],
            )

    schema = "doc_id long, n_shingles long, digest binary, sketch binary, keys array<long>"
    return common.take(docs, "doc_id", "text").mapInArrow(make, schema)


def _full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """digest, hashes: the sets of the documents whose ids are in ``wanted`` (first), and a few more.

    The ids reach the tasks as a table of at most ``MOST_BITS`` bits, so texts are not shuffled. Of
    copies a task gives the set once, as far as it remembers; more do no harm.
    """
    size = min(MOST_BITS, max(FEWEST_BITS, 1 << (8 * wanted.count()).bit_length()))
    place = F.pmod(F.xxhash64("first"), F.lit(size))
    bits = wanted.groupBy(F.floor(place / 64).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))).alias("bits")
    )
    found = bits.toArrow()
    table = np.zeros(size // 64, np.uint64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen = Shingles(words), set()
        for batch in batches:
            at = batch.column(0).to_numpy().astype(np.uint64)
            named = table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)
            digests, sets, held = [], [], 0
            for text in batch.column(1).filter(pa.array(named.astype(bool))):
                found = shingles.of(text.as_py())
                key = digest(found)
                if key in seen:
                    continue
                if len(seen) >= KNOWN:
                    seen.clear()
                seen.add(key)
                digests.append(key)
                sets.append(found.tobytes())
                held += len(sets[-1])
                if held > BUFFER_BYTES // 8:
                    yield _sets(digests, sets)
                    digests, sets, held = [], [], 0
            yield _sets(digests, sets)

    rows = common.take(docs, "doc_id", "text")
    rows = rows.select(F.pmod(F.xxhash64("doc_id"), F.lit(size)).alias("place"), "text")
    return rows.mapInArrow(make, "digest binary, hashes binary")


def _sets(digests: list[bytes], sets: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(sets, pa.binary())], ["digest", "hashes"])


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Rows that come sorted by their first ``keys`` columns, cut into whole groups."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        kept.append(batch)
        if sum(b.nbytes for b in kept) >= BUFFER_BYTES:
            rows = pa.Table.from_batches(kept)
            cut = _starts(rows, keys)[-1]
            if cut:
                yield rows.slice(0, cut)
            kept = rows.slice(cut).combine_chunks().to_batches()
    if kept and sum(map(len, kept)):
        yield pa.Table.from_batches(kept)


def _starts(rows: pa.Table, keys: int) -> list[int]:
    new = np.zeros(max(0, len(rows) - 1), bool)
    for i in range(keys):
        values = rows.column(i).to_numpy()
        new |= values[1:] != values[:-1]
    return [0, *(np.flatnonzero(new) + 1).tolist()]


def _sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, BUCKETS)


def _confirmed(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """u, v: those pairs whose full sets are similar enough.

    Rows meet by u, ``PAIRS`` of them at a time: the set of u goes once to each such group, that of
    v comes with its pair. So a node that is in very many pairs is spread over many tasks.
    """
    part = F.pmod(F.xxhash64("v"), F.ceil(F.col("n") / PAIRS)).alias("part")
    counted = store.materialise(pairs.groupBy("u").agg(F.count(F.lit(1)).alias("n")), "pair-counts")
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / PAIRS) - 1)).alias("part")
    asked = counted.select(F.col("u").alias("node"), "u", parts, F.lit(None).cast("long").alias("v"))
    answers = pairs.join(counted, "u").select(F.col("v").alias("node"), "u", part, "v")
    roles = asked.unionByName(answers).join(nodes.select("node", "digest", "first"), "node")
    roles = store.materialise(roles.select("digest", "first", "u", "part", "v"), "roles")
    sets = _full_sets(docs, roles.select("first").distinct(), words)
    keys = ["u", "part"]
    rows = sets.join(roles.drop("first"), "digest").select("u", "part", "v", "hashes")
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, F.col("v").asc_nulls_first())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, np.empty(0, np.uint64)
        for batch in batches:
            found_u, found_v = [], []
            for u, p, v, hashes in zip(*(batch.column(i) for i in range(4))):
                found = np.frombuffer(hashes.as_buffer(), "<u8")
                if not v.is_valid:
                    now, own = (u.as_py(), p.as_py()), found.copy()
                    continue
                if (u.as_py(), p.as_py()) != now:
                    raise ValueError(f"the set of node {u} is missing")
                if _alike(own, found):
                    found_u.append(u.as_py())
                    found_v.append(v.as_py())
            yield _pairs(np.array(found_u, np.int64), np.array(found_v, np.int64))

    return rows.mapInArrow(compare, "u long, v long")


def _pairs(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def _estimated(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs that are not surely below the limit by their sketches."""
    one = nodes.select(F.col("node").alias("u"), F.col("n").alias("n_u"), F.col("sketch").alias("s_u"))
    two = nodes.select(F.col("node").alias("v"), F.col("n").alias("n_v"), F.col("sketch").alias("s_v"))
    rows = pairs.join(one, "u").join(two, "v").select("u", "v", "n_u", "n_v", "s_u", "s_v")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, n_u, n_v = (batch.column(i).to_numpy() for i in range(4))
            _, near = likely(_sketches(batch.column(4)), n_u, _sketches(batch.column(5)), n_v)
            yield _pairs(u[near], v[near])

    return rows.mapInArrow(compare, "u long, v long")


def _labelled(links: DataFrame) -> DataFrame:
    """node, label: the smallest node of each node's component, for nodes with a smaller one."""
    return store.materialise(components(links).select("node", F.col("root").alias("label")), "labels")


def _joined(marked: DataFrame, links: list[DataFrame]) -> DataFrame:
    """The same after further links, which only the labels need to follow."""
    found = links[0]
    for more in links[1:]:
        found = found.unionByName(more)
    for end in ("u", "v"):
        named = marked.select(F.col("node").alias(end), F.col("label").alias("root"))
        found = found.join(named, end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
    above = _labelled(found.select("u", "v"))
    moved = marked.join(above.select(F.col("node").alias("label"), F.col("label").alias("root")), "label", "left")
    moved = moved.select("node", F.coalesce("root", "label").alias("label"))
    # Labels that moved were smallest nodes before, and so stand in no row of the table.
    return store.materialise(moved.unionByName(above.select("node", "label")), "labels")


def _open(held: DataFrame, labels: DataFrame) -> DataFrame:
    """key, node, label, size, asked: the buckets of three nodes and more in several components.

    ``asked`` marks the nodes outside the bucket's largest component. Two nodes were compared first.
    """
    rows = held.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    return _asked(store.materialise(rows, "labelled"), "key").where("size > 2")


def _asked(rows: DataFrame, group: str) -> DataFrame:
    """``rows`` (group, node, label) of the groups with several labels, with size, top (the label of
    most of the group) and asked; written."""
    counts = rows.groupBy(group, "label").agg(F.count(F.lit(1)).alias("n"))
    largest = counts.groupBy(group).agg(
        F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("labels")
    )
    largest = largest.where("labels > 1").select(group, "size", F.col("top.label").alias("top"))
    largest = store.materialise(largest, "open")
    marked = rows.join(largest, group).withColumn("asked", F.col("label") != F.col("top"))
    return store.materialise(marked, "open-rows")


def _proposed(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """u, v: each asked node with the nodes of other components in its bucket that it is not surely
    unlike. For buckets of few nodes."""
    met = rows.join(nodes.select("node", "n", "sketch"), "node").select("key", "node", "label", "asked", "n", "sketch")

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, 1):
            node, label, size = (table.column(c).to_numpy() for c in ("node", "label", "n"))
            asked = np.array(table.column("asked").to_pylist(), bool)
            sketch, starts = _sketches(table.column("sketch")), _starts(table, 1)
            found_u, found_v = [], []
            for a, b in zip(starts, [*starts[1:], len(table)]):
                for q in (a + np.flatnonzero(asked[a:b])).tolist():
                    _, near = likely(sketch[a:b], size[a:b], sketch[q], size[q])
                    found = a + np.flatnonzero(near & (label[a:b] != label[q]))
                    found_u.append(np.repeat(node[q], len(found)))
                    found_v.append(node[found])
            if found_u:
                yield _pairs(np.concatenate(found_u), np.concatenate(found_v))

    return met.repartition("key").sortWithinPartitions("key").mapInArrow(propose, "u long, v long")


def _group_links(docs: DataFrame, rows: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """u, v: links between components of groups of large buckets."""
    members = rows.select(F.col("top").alias("group"), "node", "label").distinct()
    members = _asked(store.materialise(members, "members"), "group")
    asked = members.groupBy("group").agg(F.count_if("asked").alias("questions"))
    asked = store.materialise(asked, "questions")
    blocks, parts = F.ceil(F.col("size") / BLOCK), F.ceil(F.col("questions") / ASKED)
    placed = members.join(asked, "group").join(nodes.select("node", "digest", "first", "n", "sketch"), "node")
    placed = placed.withColumns(
        {
            "block": F.pmod(F.xxhash64("node"), blocks),
            "part": F.pmod(F.xxhash64("node", F.lit(1)), parts),
            "blocks": F.sequence(F.lit(0).cast("long"), blocks - 1),
            "parts": F.sequence(F.lit(0).cast("long"), parts - 1),
        }
    )
    placed = store.materialise(placed, "placed")
    sets = _full_sets(docs, placed.select("first").distinct(), words)
    rows = sets.join(placed.drop("first"), "digest")
    cell, columns = ["group", "block", "part"], ["node", "label", "n", "sketch", "hashes"]
    questions = rows.where("asked").select("group", F.explode("blocks").alias("block"), "part", F.lit(0).alias("side"), *columns)
    answers = rows.select("group", "block", F.explode("parts").alias("part"), F.lit(1).alias("side"), *columns)
    met = questions.unionByName(answers).repartition(*cell).sortWithinPartitions(*cell, "side")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, Questions()
        for batch in batches:
            cells = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            side, node, label, size = (batch.column(i).to_numpy() for i in range(3, 7))
            found_u, found_v = [], []
            for row, cell in enumerate(cells):
                if cell != now:
                    now, held = cell, Questions()
                sketch = np.frombuffer(batch.column(7)[row].as_buffer(), "<u2")
                hashes = np.frombuffer(batch.column(8)[row].as_buffer(), "<u8")
                if side[row] == 0:
                    held.add(node[row], label[row], sketch, hashes)
                    continue
                for u in held.links(label[row], int(size[row]), sketch, hashes):
                    found_u.append(u)
                    found_v.append(node[row])
            yield _pairs(np.array(found_u, np.int64), np.array(found_v, np.int64))

    return met.mapInArrow(compare, "u long, v long")


class Questions:
    """The asked nodes of a cell. A question and a component are linked once."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.linked: set[tuple[int, int]] = set()
        self.table: tuple | None = None

    def add(self, node, label, sketch: np.ndarray, hashes: np.ndarray) -> None:
        self.rows.append((node, label, sketch.copy(), hashes.copy()))

    def links(self, label, size: int, sketch: np.ndarray, hashes: np.ndarray) -> Iterator[int]:
        """The questions that a node of the component ``label`` answers."""
        if not self.rows:
            return
        if self.table is None:
            node, labels, sketches, sets = zip(*self.rows)
            self.table = np.array(labels), np.array(sketches), np.array([len(s) for s in sets])
        labels, sketches, sizes = self.table
        _, near = likely(sketches, sizes, sketch, size)
        for i in np.flatnonzero(near & (labels != label)).tolist():
            node, own, _, mine = self.rows[i]
            if (node, label) not in self.linked and _alike(mine, hashes):
                self.linked.add((node, label))
                yield node


def _alike(one: np.ndarray, two: np.ndarray) -> bool:
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= LEAST * (len(one) + len(two) - both)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u < v").distinct()


def _nodes(found: DataFrame) -> DataFrame:
    """digest, node (a number), first (smallest id), n, sketch, keys of every set that is not empty."""
    sets = found.where("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("first"),
        F.first("n_shingles").alias("n"),
        F.first("sketch").alias("sketch"),
        F.first("keys").alias("keys"),
    )
    return store.materialise(sets.withColumn("node", F.monotonically_increasing_id()), "nodes")


def labels(docs: DataFrame, nodes: DataFrame, words: int = WORDS) -> DataFrame:
    """node, label of the nodes that are linked with another; ``nodes`` is a table of ``_nodes``."""
    placed = nodes.select("node", F.explode("keys").alias("key"))
    shared = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("least")).where("n > 1")
    shared = store.materialise(shared.select("key", "least"), "band-keys")
    held = store.materialise(placed.join(shared, "key"), "band-rows")
    met = nodes.join(held.select("node").distinct(), "node", "left_semi")
    met = store.materialise(met.select("node", "digest", "first", "n", "sketch"), "met-nodes")

    pairs = held.where("node != least").select(F.col("least").alias("u"), F.col("node").alias("v")).distinct()
    pairs = store.materialise(_estimated(pairs, met), "pairs")
    marked = _labelled(store.materialise(_confirmed(docs, pairs, met, words), "links"))
    rows = _open(held.select("key", "node"), marked)
    few = store.materialise(_ordered(_proposed(rows.where(F.col("size") <= FEW), met)), "pairs")
    large = rows.where(F.col("size") > FEW)
    links = []
    if not few.isEmpty():
        links.append(store.materialise(_confirmed(docs, few, met, words), "links"))
    if not large.isEmpty():
        links.append(store.materialise(_group_links(docs, large, met, words), "links"))
    links = [more for more in links if not more.isEmpty()]
    if links:
        marked = _joined(marked, links)
    return marked


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    found = store.materialise(sketched(docs, words), "sketched")
    nodes = _nodes(found)
    marked = labels(docs, nodes, words)
    rooted = nodes.select("digest", "node", "first").join(marked, "node", "left")
    rooted = store.materialise(rooted.select("digest", "first", F.coalesce("label", "node").alias("label")), "rooted")
    named = store.materialise(rooted.groupBy("label").agg(F.min("first").alias("component_id")), "components")
    named = store.materialise(rooted.join(named, "label").select("digest", "component_id"), "named")
    rows = found.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
