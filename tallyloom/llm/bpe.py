"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string there is exactly one token with which its encoding ends: the
token that ends there, whose front part is a prefix with a known last token, and which may
follow that last token. Two tokens may follow each other when the byte pair merges of the two
together give back these two. Storing one token per prefix, ``Prefixes`` appends bytes without
looking at earlier ones. An edit is re-encoded from its place on, until the last tokens of as many
prefixes in a row as the longest token has bytes are those from before: what follows depends on no
more than these, so the rest stays. The encoding is read off from the end.

Text is split by the vocabulary's pattern first, each match being encoded separately. A match
that is a token as a whole is that token. Tokens which their own merges do not give back can
only occur that way and take no part in the program.

NULL counts as an empty text, which has no tokens. NULL ids and repeated rows stay as they
are. An empty table gives an empty result. Other columns of the input are not looked at.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallyloom.llm import common

LIMIT = 300_000
PARTS = 200_000
PIECES = 600_000
KEPT_SIGNS = 64
SPACE = " "


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(data: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The plain definition: merge the pair of lowest rank, the leftmost of equals, until none is left."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        pairs = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
        known = [r for r in pairs if r is not None]
        if not known:
            break
        i = pairs.index(min(known))
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Vocabulary:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.reachable = {t: r for t, r in ranks.items() if merge(t, ranks) == [t]}
        self.pairs: dict[tuple[int, int], bool] = {}
        by_end: dict[bytes, set[int]] = {}
        for token in self.reachable:
            by_end.setdefault(token[-3:], set()).add(len(token))
        self.longest = max(map(len, self.reachable))
        #: Lengths of the tokens that end in these bytes, at most three, longest first.
        self.sizes = {end: sorted(sizes, reverse=True) for end, sizes in by_end.items()}

    def may_follow(self, first: int, second: int) -> bool:
        known = self.pairs.get((first, second))
        if known is None:
            if len(self.pairs) >= LIMIT:
                self.pairs.clear()
            a, b = self.bytes[first], self.bytes[second]
            known = self.pairs[first, second] = merge(a + b, self.ranks) == [a, b]
        return known


class Prefixes:
    """The last token of the encoding of each prefix of some bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = []
        self.append(data)

    def append(self, data: bytes) -> None:
        self.data += data
        for end in range(len(self.last) + 1, len(self.data) + 1):
            self.last.append(self._last_token(end))

    def _last_token(self, end: int) -> int:
        words, data, last = self.vocabulary, self.data, self.last
        for tail in (3, 2, 1):
            for size in words.sizes.get(data[end - tail : end], ()) if tail <= end else ():
                start = end - size
                if start >= 0:
                    token = words.reachable.get(data[start:end])
                    if token is not None and (start == 0 or words.may_follow(last[start - 1], token)):
                        return token
        raise ValueError(f"byte {data[end - 1]} is not in the vocabulary")

    def replace(self, start: int, end: int, data: bytes) -> None:
        """Put ``data`` in place of the bytes from ``start`` to ``end``.

        Takes time for the new bytes and for the few after them whose last token changes.
        """
        before, rest = self.last[end:], self.data[end:]
        del self.last[start:]
        self.data = self.data[:start]
        self.append(data)
        edited = len(self.data)
        self.data += rest
        same = 0
        for place, token in enumerate(before):
            self.last.append(self._last_token(edited + place + 1))
            same = same + 1 if self.last[-1] == token else 0
            if same == self.vocabulary.longest:
                self.last += before[place + 1 :]
                break

    def tokens(self) -> list[int]:
        found, end = [], len(self.data)
        while end:
            token = self.last[end - 1]
            found.append(token)
            end -= len(self.vocabulary.bytes[token])
        return found[::-1]


class Encoder:
    """Encodes texts; the first ``PARTS`` parts between single spaces and the first ``PIECES``
    matches of the pattern are kept, and so looked up later. The rest, and all that is longer than
    ``KEPT_SIGNS`` signs, is encoded each time, so that texts without spaces fill no table."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary = Vocabulary(load_ranks(path))
        self.pattern = regex.compile(pattern)
        self.pieces: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers.

        A single space between two other signs starts a match, so texts are cut there. Where a
        part starts or ends in white space itself the whole text is matched at once.
        """
        first, *rest = text.split(SPACE)
        found = list(map(self.parts.get, rest))
        if None in found:
            new = {}
            for part in {p for p, ids in zip(rest, found) if ids is None}:
                if not part or part[0].isspace() or part[-1].isspace():
                    return self._whole(text)
                new[part] = self._whole(SPACE + part)
            found = [new[p] if ids is None else ids for p, ids in zip(rest, found)]
            if len(self.parts) < PARTS:
                self.parts.update((part, ids) for part, ids in new.items() if len(part) <= KEPT_SIGNS)
        if rest and (not first or first[-1].isspace()):
            return self._whole(text)
        return b"".join([self._whole(first), *found])

    def _whole(self, text: str) -> bytes:
        return b"".join(map(self._piece, self.pattern.findall(text)))

    def _piece(self, piece: str) -> bytes:
        known = self.pieces.get(piece)
        if known is None:
            data = piece.encode()
            token = self.vocabulary.ranks.get(data)
            ids = [token] if token is not None else Prefixes(self.vocabulary, data).tokens()
            known = np.array(ids, "<u4").tobytes()
            if len(self.pieces) < PIECES and len(piece) <= KEPT_SIGNS:
                self.pieces[piece] = known
        return known

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    """One per worker and vocabulary; its tables stay between tasks."""
    return Encoder(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids and decoded, the bytes of the ids."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path, pattern)
        for batch in batches:
            ids = [words.encode(text.as_py() or "") for text in batch.column(1)]
            decoded = [words.decode(x) for x in ids]
            ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(ids), "<i4"))
            columns = [batch.column(0), lists, pa.array(decoded, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    rows = common.take(docs, "doc_id", "text")
    return rows.mapInArrow(encoded, "doc_id long, ids array<int>, decoded binary")
