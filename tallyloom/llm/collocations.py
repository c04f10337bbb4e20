"""Collocations: phrases of two and three words that occur more often than their parts suggest.

Texts have A-Z lower-cased and are cut into pieces at ``SEPARATORS``, pieces into words at spaces
and tabs. Everything is counted per language, over all contiguous occurrences within pieces.

*Toivonen mining.* Phrases with at least ``least`` occurrences are found without counting the rest:

1. A sample of documents (``SHARE``, by hash) is counted at a lowered threshold. Its frequent words
   and pairs are the proposals.
2. A pass over all documents counts exactly the proposals and their negative border, the phrases that
   are not proposed while all their shorter parts are: every word, every pair of proposed words, every
   triple of proposed pairs. Only border phrases that occur are ever held.
3. A border phrase that turns out frequent is a failure of the sample: phrases made of it were not
   counted. Where there is one, a further pass counts what failures add to the border: pairs of
   frequent words that were not counted, and triples of pairs that are frequent or among those. As it
   takes those pairs for proposals before their counts are known, no phrase that it finds frequent
   can be extended by one that is not counted: the border is closed.

Sets of phrases reach the tasks as bit tables of at most ``MOST_BITS`` bits, whatever the size of the
corpus. A phrase that shares its bit with one of them is counted too, always or never, so counts are
exact in any case; a full table costs shuffle and nothing else. Tasks count blocks of about ``BLOCK``
words before anything is shuffled, so a phrase found everywhere leaves each block once.

*Scores* use decimals, as products of counts may pass 64 bits (counts up to 10^15).

NULL text counts as empty, NULL language as ``und``. Ids only choose the sample. Repeated rows count
as often as they occur. Ties in the ranking go to the more frequent, then to the first phrase by
bytes. Texts of any length are counted whole. An empty table gives an empty result. Other columns of
the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tallyloom import store
from tallyloom.llm import common

LEAST = 10
SHARE = 0.25
LOWERED = 0.8
FIRST = 2000
INSIDE = 50
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
UNKNOWN = "und"
BLOCK, PART = 2_000_000, 250_000
FEWEST_BITS, MOST_BITS = 1 << 20, 1 << 26
#: A byte that no UTF-8 text has; as a token it stands between pieces.
BREAK = b"\xff"
_CUT = bytes.maketrans(SEPARATORS, BREAK * len(SEPARATORS))
_ID_BITS = 21
_IDS = (1 << _ID_BITS) - PART - 3


class Numbers(dict):
    """Numbers words in the order in which they are asked for; 0 is the break."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def tokens(text: str | None) -> list[bytes]:
    """Words of the text with breaks between its pieces."""
    return (text or "").encode().lower().translate(_CUT).replace(BREAK, b" " + BREAK + b" ").split()


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def pair_hashes(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    x = first * np.uint64(0x9E3779B97F4A7C15) + then
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Bits:
    """A set of hashes as a table of bits: says yes for every member and for a few others."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def has(self, found: np.ndarray) -> np.ndarray:
        place = found & np.uint64(64 * len(self.words) - 1)
        return (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


@dataclass
class Proposals:
    """Words and pairs: those of the sample, or those that a full pass found frequent."""

    words: Bits
    pairs: Bits


class Block:
    """Some documents of one language, as numbers of words.

    ``own`` marks the places where a phrase may start: a long text comes in parts, each with the two
    words that follow it.
    """

    def __init__(self) -> None:
        self.numbers = Numbers({BREAK: 0})
        self.codes: list[np.ndarray] = []
        self.own: list[np.ndarray] = []

    def add(self, words: list[bytes], own: int) -> None:
        codes = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        self.codes += [codes, np.zeros(1, np.int64)]
        self.own.append(np.arange(len(words) + 1) < own)

    def places(self, lang: str) -> tuple:
        """Words as bytes and their hashes; per place: the code, whether a word may start there, and
        for the places where a pair and a triple starts, their hashes."""
        code, own = np.concatenate(self.codes), np.concatenate(self.own)
        words = list(self.numbers)
        hashes = word_hashes(lang, words)
        word = code > 0
        pair = np.flatnonzero(word[:-1] & word[1:])
        both = np.zeros(len(code), np.uint64)
        both[pair] = pair_hashes(hashes[code[pair]], hashes[code[pair + 1]])
        is_pair = np.zeros(len(code), bool)
        is_pair[pair] = True
        triple = np.flatnonzero(is_pair[:-1] & is_pair[1:] & own[:-1])
        return words, hashes, code, own, pair, both, is_pair, triple


def _hashed(lang: str, block: Block) -> Iterator[pa.RecordBatch]:
    """(size, hash, n) of all words and pairs."""
    words, hashes, code, own, pair, both, _, _ = block.places(lang)
    n = np.bincount(code[own & (code > 0)], minlength=len(words))
    yield _hash_rows(1, hashes[n > 0], n[n > 0])
    yield _hash_rows(2, *np.unique(both[pair[own[pair]]], return_counts=True))


def _hash_rows(size: int, hashes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(np.full(len(n), size, np.int32)), pa.array(hashes.view(np.int64)), pa.array(n.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["size", "hash", "n"])


def _exact(lang: str, block: Block, proposals: Proposals, known: Proposals | None) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, n): the proposals and their border, and all words as the empty phrase; or, where
    it is ``known`` what is frequent among these, what that adds."""
    words, hashes, code, own, pair, both, _, triple = block.places(lang)
    texts = pa.array([b"", *words[1:]], pa.binary())
    proposed = proposals.words.has(hashes)
    counted = proposed[code[pair]] & proposed[code[pair + 1]]
    before, likely = np.zeros(len(code), bool), np.zeros(len(code), bool)
    before[pair] = proposals.pairs.has(both[pair])
    if known is None:
        n = np.bincount(code[own & (code > 0)], minlength=len(words))
        yield _rows(lang, [pa.array([b""], pa.binary())], np.array([n.sum()]))
        at = np.flatnonzero(n)
        yield _rows(lang, [texts.take(pa.array(at))], n[at])
        wanted = counted
        extended = before[triple] & before[triple + 1]
    else:
        often = known.words.has(hashes)
        wanted = often[code[pair]] & often[code[pair + 1]] & ~counted
        likely[pair] = wanted | known.pairs.has(both[pair])
        extended = likely[triple] & likely[triple + 1] & ~(before[triple] & before[triple + 1])
    start = pair[wanted & own[pair]]
    yield from _phrases(lang, texts, [code[start], code[start + 1]])
    start = triple[extended]
    yield from _phrases(lang, texts, [code[start], code[start + 1], code[start + 2]])


def _phrases(lang: str, texts: pa.Array, parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    joined = np.zeros(len(parts[0]), np.int64)
    for part in parts:
        joined = joined << _ID_BITS | part
    found, n = np.unique(joined, return_counts=True)
    low = (1 << _ID_BITS) - 1
    shifts = [_ID_BITS * i for i in reversed(range(len(parts)))]
    for a in range(0, len(found), 100_000):
        some = found[a : a + 100_000]
        yield _rows(lang, [texts.take(pa.array(some >> s & low)) for s in shifts], n[a : a + 100_000])


def _rows(lang: str, words: list[pa.Array], n: np.ndarray) -> pa.RecordBatch:
    phrase = words[0] if len(words) == 1 else pc.binary_join_element_wise(*words, b" ")
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(n), pa.string()), phrase.cast(pa.string()), pa.array(n, pa.int64())],
        ["lang", "phrase", "n"],
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Block]]:
    blocks: dict[str, Block] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            words = tokens(text.as_py())
            for a in range(0, len(words), PART):
                part = words[a : a + PART + 2]
                block = blocks.setdefault(lang.as_py(), Block())
                block.add(part, PART)
                size += len(part)
                if size >= BLOCK or len(block.numbers) >= _IDS:
                    yield from blocks.items()
                    blocks, size = {}, 0
    yield from blocks.items()


def hash_counts(docs: DataFrame) -> DataFrame:
    """size, hash, n over ``docs`` (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, block in _blocks(batches):
            yield from _hashed(lang, block)

    made = docs.mapInArrow(count, "size int, hash long, n long")
    return made.groupBy("size", "hash").agg(F.sum("n").alias("n"))


def exact_counts(docs: DataFrame, proposals: Proposals, known: Proposals | None = None) -> DataFrame:
    """lang, phrase, n over ``docs`` (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, block in _blocks(batches):
            yield from _exact(lang, block, proposals, known)

    made = docs.mapInArrow(count, "lang string, phrase string, n long")
    return made.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def bits(hashes: DataFrame) -> Bits:
    """The bit table of a written table (hash): at most ``MOST_BITS`` bits come to the driver."""
    rows = hashes.count()
    size = min(MOST_BITS, max(FEWEST_BITS, 1 << (8 * rows).bit_length()))
    # The lower bits of the hash, as ``Bits`` takes them of the unsigned number.
    place = F.col("hash").bitwiseAND(F.lit(size - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    words = hashes.groupBy(F.floor(place / 64).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(size // 64, np.uint64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return Bits(table)


def _phrase_hashes(phrases: DataFrame) -> DataFrame:
    """size, hash of the words and pairs of a table (lang, phrase), written."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, hashes = [], []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts = word_hashes(lang, phrase.encode().split(b" "))
                sizes.append(len(parts))
                hashes.append(parts[0] if len(parts) == 1 else pair_hashes(parts[:1], parts[1:])[0])
            columns = [pa.array(sizes, pa.int32()), pa.array(np.array(hashes, np.uint64).view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["size", "hash"])

    rows = phrases.where((F.col("phrase") != "") & (F.size(F.split("phrase", " ")) < 3))
    return store.materialise(rows.select("lang", "phrase").mapInArrow(make, "size int, hash long"), "phrase-hashes")


def _missed(hashes: DataFrame, proposals: Proposals) -> bool:
    """Whether a frequent word or pair was not proposed."""

    def outside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, found = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            away = np.where(size == 1, ~proposals.words.has(found), ~proposals.pairs.has(found))
            if away.any():
                yield pa.RecordBatch.from_arrays([pa.array([int(away.sum())], pa.int64())], ["n"])

    return not hashes.select("size", "hash").mapInArrow(outside, "n long").isEmpty()


def _proposals(hashes: DataFrame) -> Proposals:
    return Proposals(*(bits(hashes.where(F.col("size") == k)) for k in (1, 2)))


def frequent(docs: DataFrame, least: int = LEAST, share: float = SHARE, lowered: float = LOWERED) -> DataFrame:
    """lang, phrase, n: all phrases of one to three words with at least ``least`` occurrences, and
    the number of all words of each language as the empty phrase."""
    rows = common.take(docs, "doc_id", "text", "lang")
    rows = rows.select("doc_id", F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    sampled = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < int(share * (1 << 20))
    some = hash_counts(rows.where(sampled).select("lang", "text"))
    some = store.materialise(some.where(F.col("n") >= max(1, int(least * share * lowered))), "sample-phrases")
    rows = rows.select("lang", "text")
    proposals = _proposals(some)
    enough = (F.col("n") >= least) | (F.col("phrase") == "")
    found = store.materialise(exact_counts(rows, proposals).where(enough), "phrases")
    hashes = _phrase_hashes(found)
    if not _missed(hashes, proposals):
        return found
    more = exact_counts(rows, proposals, _proposals(hashes)).where(enough)
    return found.unionByName(store.materialise(more, "further-phrases"))


def ranked(phrases: DataFrame, inside: int = INSIDE, first: int = FIRST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the first phrases of each language.

    Cut after k words, a phrase of a occurrences has parts of l and r; its score is the lowest of
    floor(1000000 a a / (l r)) over k, the first k among equals. A phrase goes if it lies in a
    longer one with at least ``inside`` per cent of its occurrences.
    """
    words = F.split("phrase", " ")
    total = phrases.where("phrase = ''").select("lang", F.col("n").alias("total"))
    known = phrases.where("phrase <> ''").select("lang", "phrase", "n")
    long = known.withColumn("words", words).where(F.size("words") > 1).withColumnRenamed("n", "a")
    cut = F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    cuts = long.select("lang", "phrase", "a", "words", cut).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ").alias("tail"),
    )
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    score = F.expr(
        "CAST(1000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(15, 0)) * CAST(a AS DECIMAL(15, 0))"
        " DIV (CAST(l AS DECIMAL(15, 0)) * CAST(r AS DECIMAL(15, 0)))"
    )
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    part = F.explode(
        F.array(*(F.array_join(F.slice("words", at, 2), " ") for at in (1, 2)))
    ).alias("phrase")
    longer = long.where(F.size("words") == 3).select("lang", part, F.col("a").alias("n"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("n").alias("longest"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(
        F.col("longest").isNull() | (F.lit(100) * F.col("longest") < F.lit(inside) * F.col("a"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    kept = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= first)
    return kept.join(total, "lang").select("lang", "rank", "phrase", "a", "cut.l", "cut.r", F.col("total").alias("n"), "cut.score")


def collocations(docs: DataFrame, least: int = LEAST, inside: int = INSIDE, first: int = FIRST) -> DataFrame:
    """The first collocations of each language of ``docs`` (doc_id, text, lang)."""
    return ranked(frequent(docs, least), inside, first)
