"""Spelling variants: rare words one edit away from a word that is far more frequent.

*Words.* Maximal runs of the letters ``LETTERS``, A-Z in lower case, of at least ``SHORTEST`` code
points and ``OFTEN`` occurrences over all documents. A digest of document id and run picks one run
in ``TYPO_IN``, from which one letter is deleted (the query's noise, on in ``typos``).

*Neighbours* are words that differ by exactly one inserted, deleted or replaced code point.

*Where two neighbours meet.* Of a pair whose longer word has L code points, either the first or the
last (L - 1) // 2 code points are the same, as one edit cannot touch both. So each word goes to four
groups: for L its own length or one more, by its first or its last code points. Words of the second
kind of group are read from their end. Groups of more than ``BLOCK`` words are cut into blocks, and
every pair of its blocks meets; none is dropped.

*Sorted-list dynamic programming.* A group's words are sorted and scanned once, for all words asked
at the same time. Of the edit matrix between the scanned word and a word asked only the band of
three cells around the diagonal can hold 0 or 1. Its row at a depth depends on the prefix alone, so
rows are kept by depth and the next word starts from the row of the prefix it shares with the one
before (their LCP). A row lists only the asked words that are still within one edit, and of a list
that asks itself only those after the scanned word, as each pair is found once; where none is left
the scan skips all words that share the prefix.

*Form and root.* A word's form is its neighbour of the largest count (ties: the first by code
points) if that has at least ``TIMES`` its count. Counts grow with every step, so forms have no
cycles, and roots are found by pointer doubling in a few rounds.

NULL text has no words; a NULL id is written as an empty one in the digest. Ids only choose the
typos. Repeated rows count as often as they occur. Texts and runs of any length are read whole. An
empty table gives an empty result. Other columns of the input are not looked at.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyloom import store
from tallyloom.llm import common

SHORTEST = 7
OFTEN = 2
TIMES = 10
TYPO_IN = 31
LETTERS = "A-Za-zÀ-ÿ"
BLOCK = 8192
HELD, HELD_SIGNS = 100_000, 20_000_000
ROWS = 200_000
#: Larger than any distance that counts.
FAR = 2
SMALL = 24
_RUNS = re.compile(f"[{LETTERS}]{{{SHORTEST},}}")
_LOWER = str.maketrans(common.UPPER, common.LOWER)


def runs(text: str | None) -> Counter:
    """Lower-cased runs that can give a word, with their occurrences in the text."""
    return Counter(run.translate(_LOWER) for run in _RUNS.findall(text or ""))


def typo(doc_id: int | None, run: str) -> str:
    """The run as the document ``doc_id`` has it: without one letter where the digest says so."""
    digest = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if digest % TYPO_IN:
        return run
    place = digest % len(run)
    return run[:place] + run[place + 1 :]


def vocabulary(docs: DataFrame, typos: bool = True) -> DataFrame:
    """word, n: the words of all documents with at least ``OFTEN`` occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, signs = Counter(), 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for run, n in runs(text.as_py()).items():
                    word = typo(doc_id, run) if typos else run
                    if len(word) >= SHORTEST:
                        held[word] += n
                        signs += len(word)
                if len(held) >= HELD or signs >= HELD_SIGNS:
                    yield _counts(held)
                    held, signs = Counter(), 0
        yield _counts(held)

    made = common.take(docs, "doc_id", "text").mapInArrow(count, "word string, n long")
    return made.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= OFTEN)


def _counts(held: Counter) -> pa.RecordBatch:
    columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["word", "n"])


def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, one row each, and their lengths. Column i + 1 holds code point i."""
    size = np.array([len(w) for w in words], np.int64)
    points = np.zeros((len(words), int(size.max(initial=0)) + 4), np.uint32)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    row = np.repeat(np.arange(len(words)), size)
    points[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size) + 1] = flat
    return points, size


def shared_prefixes(words: list[str]) -> np.ndarray:
    """Of each word but the first of a sorted list, how many code points it shares with the last."""
    points, size = _matrix(words)
    same = (points[1:, 1:] == points[:-1, 1:]) & (points[1:, 1:] != 0)
    return np.minimum.accumulate(same, axis=1).sum(axis=1) if len(words) > 1 else np.empty(0, np.int64)


class Scan:
    """Neighbours of words asked in sorted lists, by one scan of each list."""

    def __init__(self, words: list[str]):
        """``words`` are all that will be asked, of however many lists."""
        self.words = words
        points, self.size = _matrix(words)
        self.points = np.ascontiguousarray(points.T)
        #: FAR where a word has no such code point, so that no cell stands for it.
        self.pads = np.where(np.arange(len(self.points))[:, None] > self.size, FAR, 0).astype(np.int8)
        #: By depth: places and cells as arrays, or for up to ``SMALL`` places (place, cells) in a list.
        self.rows: list = []

    def _ask(self, asked: np.ndarray) -> None:
        # Before the first letter: distances to the first -1, 0 and 1 code points of a word asked.
        start = np.full((len(asked), 3), FAR, np.int8)
        start[:, 1], start[:, 2] = 0, np.where(self.size[asked] >= 1, 1, FAR)
        self.rows = [self._held(asked, start)]

    @staticmethod
    def _held(active: np.ndarray, cells: np.ndarray):
        if len(active) > SMALL:
            return active, [np.ascontiguousarray(c) for c in cells.T]
        return [(i, *row) for i, row in zip(active.tolist(), cells.tolist())]

    def _next(self, point: int, after: int) -> None:
        """The row one letter deeper, from the deepest one held."""
        depth = len(self.rows) - 1
        if isinstance(self.rows[-1], list):
            self.rows.append(self._next_few(self.rows[-1], depth, chr(point), after))
            return
        active, (low, mid, high) = self.rows[-1]
        # Cell k of a row at depth d stands for the first d + k - 1 code points of the word asked.
        differs = [self.points[depth + k][active] != point for k in range(3)]
        first = np.minimum(low + differs[0], mid + 1)
        first = np.maximum(first, self.pads[depth][active])
        second = np.minimum(np.minimum(mid + differs[1], high + 1), first + 1)
        second = np.maximum(second, self.pads[depth + 1][active])
        third = np.maximum(np.minimum(high + differs[2], second + 1), self.pads[depth + 2][active])
        alive = np.flatnonzero((np.minimum(np.minimum(first, second), third) <= 1) & (active > after))
        cells = np.minimum(np.array([first[alive], second[alive], third[alive]]), FAR).T
        self.rows.append(self._held(active[alive], cells))

    def _next_few(self, row: list, depth: int, sign: str, after: int) -> list:
        """The same for few words, for which arrays cost more than they spare."""
        out, words = [], self.words
        for i, low, mid, high in row:
            word = words[i]
            size = len(word)
            if depth > size or i <= after:
                continue
            first = min(low + (depth == 0 or word[depth - 1] != sign), mid + 1)
            second = third = FAR
            if depth < size:
                second = min(mid + (word[depth] != sign), high + 1, first + 1)
                if depth + 1 < size:
                    third = min(high + (word[depth + 1] != sign), second + 1)
            if first < FAR or second < FAR or third < FAR:
                out.append((i, min(first, FAR), min(second, FAR), min(third, FAR)))
        return out

    def _hits(self, size: int) -> list[int]:
        """Places of the words that are one edit from the scanned word of this size."""
        row = self.rows[-1]
        if isinstance(row, list):
            return [i for i, *cells in row if 0 <= (off := len(self.words[i]) - size + 1) <= 2 and cells[off] == 1]
        active, cells = row
        off = self.size[active] - size + 1
        inside = (off >= 0) & (off <= 2)
        cells = np.array(cells)
        return active[inside][cells[off[inside], np.flatnonzero(inside)] == 1].tolist()

    def _left(self) -> int:
        row = self.rows[-1]
        return len(row) if isinstance(row, list) else len(row[0])

    def near(self, asked: np.ndarray, listed: list[str], shared: list[int], own: bool) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``words`` and in ``listed`` of the pairs that are exactly one edit apart.

        ``shared[i]`` tells how many code points the i-th word shares with the one before. ``own``
        says that the words asked are the listed ones, in their order: a pair is then found where its
        first word is listed.
        """
        self._ask(asked)
        found_asked, found_listed = [], []
        first = int(asked[0]) if own and len(asked) else 0
        dead = None  # depth of a prefix that no word asked is near to
        for place, (word, lcp) in enumerate(zip(listed, shared)):
            if dead is not None:
                if lcp >= dead:
                    continue
                dead = None
            del self.rows[lcp + 1 :]
            after = first + place if own else -1
            for point in map(ord, word[len(self.rows) - 1 :]):
                self._next(point, after)
                if not self._left():
                    dead = len(self.rows) - 1
                    break
            else:
                hit = [i for i in self._hits(len(word)) if i > after]
                found_asked += hit
                found_listed += [place] * len(hit)
        return np.array(found_asked, np.int64), np.array(found_listed, np.int64)


def _pairs(words: list[str], starts: list[int], asked: np.ndarray, longer: np.ndarray, backwards: np.ndarray):
    """Places of the ordered pairs of near words of each group, whose longer word is of full length.

    ``asked`` marks the words of the first of two blocks; where they are one block all are both.
    Pairs that share their first half are left to the group of that.
    """
    scan, shared = Scan(words), [0, *shared_prefixes(words).tolist()]
    one, two = [], []
    for a, b in zip(starts, [*starts[1:], len(words)]):
        if asked[a] == 2:
            shared[a] = 0
            x, y = scan.near(np.arange(a, b), words[a:b], shared[a:b], True)
            x, y = np.concatenate([x, y + a]), np.concatenate([y + a, x])
        else:
            answers = a + np.flatnonzero(asked[a:b] == 1)
            listed = [words[i] for i in answers]
            x, y = scan.near(a + np.flatnonzero(asked[a:b] == 0), listed, [0, *shared_prefixes(listed).tolist()], False)
            y = answers[y]
        one.append(x)
        two.append(y)
    x, y = np.concatenate(one), np.concatenate(two)
    right = np.maximum(scan.size[x], scan.size[y]) == longer[x]
    for i in np.flatnonzero(right & backwards[x]).tolist():
        half = (longer[x[i]] - 1) // 2
        right[i] = words[x[i]][-half:] != words[y[i]][-half:]
    return x[right], y[right]


def neighbours(words: DataFrame) -> DataFrame:
    """word, near, near_n: every ordered pair of neighbours, once; ``words`` (word, n) is a table."""
    size = F.length("word")
    keys = F.array(
        *(
            F.struct(
                (size + more).alias("longer"),
                F.lit(backwards).alias("backwards"),
                F.substring(F.reverse("word") if backwards else F.col("word"), F.lit(1), F.floor((size + more - 1) / 2).cast("int")).alias("part"),
            )
            for more in (0, 1)
            for backwards in (False, True)
        )
    )
    placed = words.select("word", "n", F.explode(keys).alias("key")).select("word", "n", "key.*")
    group = ["longer", "backwards", "part"]
    # A group without a word of the full length has no pair of its own, nor has one of a single word.
    full = F.max(F.length("word") == F.col("longer")).alias("full")
    sizes = placed.groupBy(*group).agg(F.count(F.lit(1)).alias("size"), full).where("size > 1 AND full")
    sizes = store.materialise(sizes.select(*group, "size"), "word-groups")
    blocks = F.ceil(F.col("size") / BLOCK)
    rows = placed.join(sizes, group).withColumn("blocks", blocks)
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("word"), F.col("blocks")))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    # Who asks: 0 the words of block a, 1 answer from block b, 2 both where a is b.
    columns = [*group, "word", "n"]
    first = rows.select(*columns, F.col("mine").alias("a"), every.alias("b")).withColumn("asked", F.when(F.col("a") == F.col("b"), 2).otherwise(0))
    second = rows.select(*columns, every.alias("a"), F.col("mine").alias("b")).where("a <> b").withColumn("asked", F.lit(1))
    meet = [*group, "a", "b"]
    text = F.when(F.col("backwards"), F.reverse("word")).otherwise(F.col("word"))
    met = first.unionByName(second).withColumn("word", text).repartition(*meet).sortWithinPartitions(*meet, "word")
    met = met.select("longer", "backwards", "part", "a", "b", "word", "n", "asked")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_groups(batches, 5):
            starts = _starts(rows, 5)
            words = rows.column("word").to_pylist()
            n, asked = rows.column("n").to_numpy(), rows.column("asked").to_numpy()
            longer = rows.column("longer").to_numpy()
            backwards = rows.column("backwards").to_numpy(zero_copy_only=False)
            # Words of one length at a time: a matrix of them is as large as they are.
            cuts = [0, *(np.flatnonzero(longer[1:] != longer[:-1]) + 1).tolist(), len(words)]
            one, two = [], []
            for a, b in zip(cuts, cuts[1:]):
                mine = [x - a for x in starts[bisect_left(starts, a) : bisect_left(starts, b)]]
                x, y = _pairs(words[a:b], mine, asked[a:b], longer[a:b], backwards[a:b])
                one.append(x + a)
                two.append(y + a)
            one, two = np.concatenate(one), np.concatenate(two)
            read = [w[::-1] if back else w for w, back in zip(words, backwards)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([read[i] for i in one], pa.string()), pa.array([read[i] for i in two], pa.string()), pa.array(n[two])],
                ["word", "near", "near_n"],
            )

    return met.mapInArrow(find, "word string, near string, near_n long")


def _starts(rows: pa.Table, keys: int) -> list[int]:
    new = np.zeros(max(0, len(rows) - 1), bool)
    for i in range(keys):
        codes = rows.column(i).combine_chunks().dictionary_encode()
        codes = codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes
        codes = codes.indices.to_numpy()
        new |= codes[1:] != codes[:-1]
    return [0, *(np.flatnonzero(new) + 1).tolist()]


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of about ``ROWS`` rows that end where a group ends."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        kept.append(batch)
        if sum(map(len, kept)) >= ROWS:
            rows = pa.Table.from_batches(kept)
            cut = _starts(rows, keys)[-1]
            if cut:
                yield rows.slice(0, cut)
            kept = rows.slice(cut).combine_chunks().to_batches()
    if sum(map(len, kept)):
        yield pa.Table.from_batches(kept)


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: where following ``forms`` (word, form) ends, by doubling the steps each round."""
    now = store.materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        after = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = now.join(after, "root", "left")
        moved = store.materialise(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        now = moved.select("word", "root")


def variants(docs: DataFrame, typos: bool = True, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the documents."""
    words = store.materialise(vocabulary(docs, typos), "words")
    least = F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near").alias("near")))
    near = neighbours(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), least.alias("best"))
    rows = words.join(near, "word", "left")
    top = -F.col("best.minus_n")
    likely = top >= times * F.col("n")
    rows = rows.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(likely, F.col("best.near")).alias("form"),
        F.when(likely, top).alias("form_n"),
    )
    rows = store.materialise(rows, "variants")
    roots = _roots(rows.where(F.col("form").isNotNull()))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
