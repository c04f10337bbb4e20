"""Token ids of texts by a vocabulary file of the ``tokenizers`` library.

Texts of ASCII and Latin-1 letters are cut at white space and where the vocabulary's own pattern
cuts; a text's ids are those of its pieces, one after another. Such texts need none of the
library's Unicode steps but the lower case, so its model is asked directly, once for each new
piece; later ones are looked up. All other texts go to the library whole. The table takes the
first pieces of at most ``KNOWN_SIGNS`` signs, the frequent ones among them, up to ``TABLE_BYTES``;
the rest, and every longer run, is asked for again. Arrow
finds the different runs of a block of texts, so Python handles each of them once and not
every word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

TABLE_BYTES = 32_000_000
# Of one entry besides its signs and ids: two Python objects and a place in the table.
ENTRY_BYTES = 200
KNOWN_SIGNS = 48
BLOCK = 1_500_000
SPECIAL = "<|"
# The sign that stands for each byte in byte-level vocabularies: itself where it prints.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
OTHERS = [b for b in range(256) if b not in PRINTED]
SIGNS = {b: b for b in PRINTED} | {b: 256 + i for i, b in enumerate(OTHERS)}
PLAIN = r"\A[\t\n\r -~À-ÖØ-öø-ÿ]*\z"
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")


def blocks(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of about ``BLOCK`` bytes and at least one text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        before = sizes[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(sizes, before + BLOCK, "right")))
        yield texts.slice(first, last - first)
        first = last


class WordTokens:
    """Ids of a lower-casing vocabulary that drops white space and splits words from signs."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}
        self.held = 0

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """One array of unsigned 32-bit ids per text; NULL counts as empty."""
        for block in blocks(texts.cast(pa.large_string()).fill_null("")):
            special = pc.match_substring(block, SPECIAL)
            plain = pc.and_not(pc.match_substring_regex(block, PLAIN), special)
            easy = self._plain(block.filter(plain))
            for text, is_plain in zip(block, plain.to_pylist()):
                yield next(easy) if is_plain else self._other(text.as_py())

    def _plain(self, texts: pa.Array) -> Iterator[np.ndarray]:
        split = pc.ascii_split_whitespace(pc.utf8_lower(texts))
        runs = split.flatten().dictionary_encode()
        ids = self._runs(runs.dictionary.to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = np.cumsum(size) - size
        code = runs.indices.to_numpy()
        n = size[code]
        ends = np.cumsum(n)
        place = np.arange(n.sum(), dtype=np.int32)
        place += np.repeat((first[code] - ends + n).astype(np.int32), n)
        flat = np.frombuffer(b"".join(ids), "<u4")[place]
        cuts = np.concatenate([[0], ends])[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return (flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()))

    def _other(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _runs(self, runs: list[str]) -> list[bytes]:
        """Ids of lower-case runs without white space."""
        found = list(map(self.known.get, runs))
        new = [run for run, ids in zip(runs, found) if ids is None]
        # Runs of letters are one piece.
        cut = {run: PIECES.findall(run) for run in new if not run.isalpha()}
        pieces = {p for pieces in cut.values() for p in pieces}.difference(self.known)
        answers = self._ask(pieces.union(filter(str.isalpha, new)))
        joined = {
            run: b"".join([answers[p] if p in answers else self.known[p] for p in pieces])
            for run, pieces in cut.items()
            if run not in answers
        }
        self._learn(answers)
        self._learn(joined)
        answers |= joined
        return [answers[run] if ids is None else ids for run, ids in zip(runs, found)]

    def _learn(self, ids: dict[str, bytes]) -> None:
        if self.held >= TABLE_BYTES:
            return
        new = {run: found for run, found in ids.items() if len(run) <= KNOWN_SIGNS}
        self.known.update(new)
        self.held += sum(ENTRY_BYTES + len(run) + len(found) for run, found in new.items())

    def _ask(self, pieces: set[str]) -> dict[str, bytes]:
        signs = (p if p.isascii() else p.encode().decode("latin-1").translate(SIGNS) for p in pieces)
        ids = [[t.id for t in self.model.tokenize(p)] for p in signs]
        ends = np.cumsum([0, *map(len, ids)]).tolist()
        flat = np.fromiter((i for found in ids for i in found), "<u4").tobytes()
        return {p: flat[4 * a : 4 * b] for p, a, b in zip(pieces, ends, ends[1:])}


@lru_cache(maxsize=4)
def word_tokens(path: str) -> WordTokens:
    """One per worker and file; its table stays between tasks."""
    return WordTokens(path)
