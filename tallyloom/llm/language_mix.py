"""Language identification as a mixture: which languages a text is made of, and in which shares.

A language is a distribution over hashed character n-grams of ``GRAM`` signs (letters in lower
case, everything else as one space) and, smoothed, over ``WIDTH`` slots. A text is taken for
draws from a mixture of languages. Expectation-maximisation estimates the shares from the
likelihoods of its n-grams. The set of languages starts with all of them; the one with the
smallest share is left out as long as the likelihood, less ``PENALTY`` times the logarithm of
the number of n-grams for each language, does not fall. Fewer parts are so preferred unless the
text speaks for more.

The distributions are learned from at most ``PER_LANGUAGE`` texts of each language, those whose
id has the smallest hash, and their ids are sent to all tasks; every text is judged.

Whether a text is in any learned language at all is another question: shares always sum to 1. Under a
background model its n-grams fall on slots by chance, and so on those that any language was seen to
use as often as there are such slots. ``keep`` lets a text go that has at least ``EVIDENCE`` different
n-grams and hits those slots no more often than that, within ``DEVIATIONS`` standard deviations.

NULL texts and texts without a letter are ``und`` with score 0, and so is every text where no
language was learned. Ties go to the language that comes first by name. NULL languages are not
learned from. NULL ids and repeated rows stay as they are. An empty table gives an empty result.
Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.llm import common

GRAM = 3
WIDTH = 1 << 15
PER_LANGUAGE = 2_000
SMOOTHING = 0.1
PENALTY = 0.5
STEPS = 15
UNKNOWN = "und"
EVIDENCE = 20
DEVIATIONS = 3.0


def _signs() -> np.ndarray:
    """For every code point of the first plane: itself in lower case if a letter, else a space."""
    table = np.full(1 << 16, ord(" "), np.uint32)
    for point in range(1 << 16):
        sign = chr(point)
        if sign.isalpha():
            lower = sign.lower()
            table[point] = ord(lower) if len(lower) == 1 else point
    return table


SIGNS = _signs()


def slots(text: str | None) -> np.ndarray:
    """Hashed n-grams of the text in order; none where it has no letter."""
    points = np.frombuffer((text or "").encode("utf-32-le"), "<u4")
    signs = SIGNS[np.minimum(points, (1 << 16) - 1)]
    high = points >= 1 << 16
    if high.any():
        signs = np.where(high & np.array([chr(p).isalpha() for p in points]), points, signs)
    blank = signs == ord(" ")
    if blank.all():
        return np.empty(0, np.int64)
    keep = np.concatenate([[True], ~(blank[1:] & blank[:-1])])
    padded = np.concatenate([[ord(" ")], signs[keep], [ord(" ")]]).astype(np.uint64)
    code = np.zeros(len(padded) - GRAM + 1, np.uint64)
    for i in range(GRAM):
        code = code * np.uint64(0x100000001B3) + padded[i : i + len(code)]
    return ((code ^ (code >> np.uint64(29))) % np.uint64(WIDTH)).astype(np.int64)


@dataclass
class Languages:
    names: list[str]
    logs: np.ndarray  # slot by language: logarithm of its probability

    def __post_init__(self) -> None:
        self.likely = np.exp(self.logs)
        # A slot that a language never used has that language's lowest probability.
        self.used = (self.logs > self.logs.min(axis=0) + 1e-9).any(axis=1) if self.names else np.zeros(WIDTH, bool)

    def by_chance(self, slot: np.ndarray) -> bool:
        """Whether these different slots hit the used ones no more often than any slots would."""
        share, n = float(self.used.mean()), len(slot)
        most = n * share + DEVIATIONS * np.sqrt(n * share * (1 - share))
        return n >= EVIDENCE and int(self.used[slot].sum()) <= most


def fit(docs: DataFrame, usable: Column, limit: int = PER_LANGUAGE) -> Languages:
    """Languages of the rows of ``docs`` (doc_id, text, lang) with ``usable`` ids."""
    known = common.take(docs, "doc_id", "text", "lang").where(usable & F.col("lang").isNotNull())
    # A share of each language that holds about twice the limit, then exactly the limit. The
    # sizes, one row a language, are sent out, as no row may travel by language before that.
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    key = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31))
    ids = known.select("lang", "doc_id", key.alias("key")).join(F.broadcast(sizes), "lang")
    ids = ids.where(F.col("key") < F.lit(float(1 << 31)) * 2 * limit / F.col("size"))
    first = Window.partitionBy("lang").orderBy("key", "doc_id")
    ids = ids.withColumn("place", F.row_number().over(first)).where(F.col("place") <= limit)
    some = known.join(F.broadcast(ids.select("lang", "doc_id").distinct()), ["lang", "doc_id"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                if lang not in counts:
                    counts[lang] = np.zeros(WIDTH, np.int64)
                counts[lang] += np.bincount(slots(text), minlength=WIDTH)
        for lang, held in counts.items():
            used = np.flatnonzero(held)
            columns = [pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(held[used])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "slot", "n"])

    parts = some.select("lang", "text").mapInArrow(count, "lang string, slot long, n long")
    rows = parts.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(rows["lang"].unique())
    counts = np.full((WIDTH, len(names)), SMOOTHING)
    counts[rows["slot"].to_numpy(int), [names.index(x) for x in rows["lang"]]] += rows["n"].to_numpy(float)
    return Languages(names, np.log(counts / counts.sum(axis=0)))


def shares(likely: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares of the languages and the log-likelihood, by expectation-maximisation."""
    share = np.full(likely.shape[1], 1 / likely.shape[1])
    total = counts.sum()
    for _ in range(STEPS if likely.shape[1] > 1 else 0):
        mixed = likely * share
        share = counts @ (mixed / mixed.sum(axis=1, keepdims=True)) / total
    return share, float(counts @ np.log(likely @ share))


def judge(text: str | None, languages: Languages) -> tuple[str, float, dict[str, float]]:
    """The language with the largest share, that share, and all shares of the chosen set."""
    found = slots(text)
    if not len(found) or not languages.names:
        return UNKNOWN, 0.0, {}
    slot, counts = np.unique(found, return_counts=True)
    likely, charge = languages.likely[slot], PENALTY * np.log(len(found) + 1)
    chosen = np.arange(len(languages.names))
    share, fit = shares(likely, counts)
    while len(chosen) > 1:
        left = np.delete(np.arange(len(chosen)), share.argmin())
        next_share, next_fit = shares(likely[:, chosen[left]], counts)
        if next_fit + charge < fit:
            break
        chosen, share, fit = chosen[left], next_share, next_fit
    best = int(share.argmax())
    names = {languages.names[i]: float(s) for i, s in zip(chosen.tolist(), share)}
    return languages.names[chosen[best]], float(min(share[best], 1.0)), names


def detect(docs: DataFrame, languages: Languages) -> DataFrame:
    """doc_id, lang_pred, score (its share), shares (of all languages found) of every document."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge(text.as_py(), languages) for text in batch.column(1)]
            lang, score, mix = zip(*rows) if rows else ((), (), ())
            columns = [
                batch.column(0),
                pa.array(lang, pa.string()),
                pa.array(score, pa.float64()),
                pa.array([list(m.items()) for m in mix], pa.map_(pa.string(), pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "shares"])

    schema = "doc_id long, lang_pred string, score double, shares map<string,double>"
    return common.take(docs, "doc_id", "text").mapInArrow(judged, schema)


def keep(docs: DataFrame, languages: Languages) -> DataFrame:
    """The rows of ``docs``, all columns, that are in learned languages; a NULL ``lang`` is filled.

    ``und`` texts go, and those whose n-grams the background model explains. Shares say how mixed a
    text is, so none is too small, and texts of several languages stay; short texts of which too
    little can be said stay too. A ``lang`` that is given is not changed.
    """
    plain, (text,) = common.plain(docs, "text")
    at = plain.columns.index(text)
    lang_at = docs.columns.index("lang") if "lang" in docs.columns else None

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            found = [judge(text, languages)[0] for text in texts]
            known = [
                lang != UNKNOWN and not languages.by_chance(np.unique(slots(text))) for lang, text in zip(found, texts)
            ]
            columns = [*batch.columns]
            if lang_at is not None:
                given = columns[lang_at]
                columns[lang_at] = pc.coalesce(given, pa.array(found, given.type))
            batch = pa.RecordBatch.from_arrays(columns, batch.schema.names)
            yield batch.filter(pa.array(known, pa.bool_()))

    return common.named(plain.mapInArrow(kept, plain.schema), docs)
