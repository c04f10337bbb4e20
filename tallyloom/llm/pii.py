"""Personal data in texts: fixed patterns, and spans added by weak supervision.

*Base spans* are those of the four fixed patterns (``base_spans``); they always stay.

*Candidates* are the base spans and looser finds: mail addresses with a written-out at sign or dot,
national phone numbers, card-like numbers that fail a base test, addresses with eight groups, and
long mixed strings that may be access tokens (kind ``secret``, which has no base pattern). Five
labelers vote yes, no or nothing on each: its form, a validity test (checksum, ranges, top-level
domain), a gazetteer (providers, prefixes, words of prose), the words around it, and the signs next
to it.

*Aggregation.* Candidates of all documents are counted by pattern: kind, votes, ``SHAPES`` of the
span and ``PLACES`` of its surroundings, ``CODES`` patterns whatever the size of the corpus.
Expectation-maximisation over the votes estimates how reliable each labeler is for each kind,
starting from and smoothed by ``TRUST``, and the probability that each pattern is personal data. A
logistic regression is trained on those probabilities, weighted with the counts, from the votes,
the shape and the surroundings; it is the final span classifier. A candidate that it gives at least
``THRESHOLD`` is added, unless it overlaps a base span or a likelier candidate.

Whole texts are searched, in time that grows with their length; no part of a pattern is capped but
card and phone numbers (by their digits). Of equally likely candidates the first is added. NULL counts as empty: no
spans. NULL ids and repeated rows stay as they are. An empty table gives an empty result, and
a corpus without candidates a model that adds nothing. Other columns are not looked at;
``redact`` carries them along.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import namedtuple
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyloom import store
from tallyloom.llm import common

KINDS = ("email", "ip", "card", "phone", "secret")
EMAIL, IP, CARD, PHONE, SECRET = range(5)
BASE_KINDS = KINDS[:4]
LABELERS = 5
SHAPES, PLACES = 16, 8
CODES = len(KINDS) * 3**LABELERS * SHAPES * PLACES
THRESHOLD = 0.9
ROUNDS = 50
WINDOW, AFTER = 40, 12

# The base patterns. Digit runs need no second start inside a run.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP_RE = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD_RE = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE_RE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser finds.
_AT, _DOT = "at|ät|arroba|arobase", "dot|punkt|punto|point"
AT = re.compile(rf"\s?[(\[{{](?:{_AT})[)\]}}]\s?|\s(?:{_AT})\s|@", re.I)
DOT = re.compile(rf"\s?[(\[{{](?:{_DOT})[)\]}}]\s?|\s(?:{_DOT})\s", re.I)
WRITTEN = re.compile(rf"[(\[{{](?:{_AT}|{_DOT})[)\]}}]|\s(?:{_DOT})\s", re.I)
LABEL = re.compile("[A-Za-z0-9-]+")
GROUPS = re.compile(r"(?<![0-9A-Za-z+.,/-])(?:\([0-9]+\) ?)?[0-9]+(?:[ ./-][0-9]+)*")
IP6_RE = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])")
MIXED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}")

DOMAINS = set("com org net edu gov mil int info biz io co uk de fr es it nl be ch at eu us ca au jp".split())
PROVIDERS = set("gmail googlemail yahoo hotmail outlook gmx web orange free proton icloud aol mail example".split())
PROSE = set(
    "the a this that it be are was is we me us them here there look meet meeting arrive arrived stay stayed live lives"
    " open once all not just only still back home work noon night him her you they and or".split()
)
ISSUERS = tuple("4 51 52 53 54 55 34 37 35 36 38 6011 65".split())
PREFIXES = tuple("sk- sk_ pk_ ghp_ gho_ github_pat_ AKIA ASIA AIza xoxb- xoxp- eyJ glpat-".split())
WORDS = {
    EMAIL: "mail email e-mail contact write reach correo courriel",
    IP: "ip address host server adresse dirección",
    CARD: "card visa mastercard amex credit debit carte karte tarjeta",
    PHONE: "phone tel call mobile fax cell contact telefon téléphone teléfono",
    SECRET: "token secret key apikey api_key password passwd pwd auth bearer credential credentials passphrase",
}
BEFORE = {k: re.compile(r"\b(?:" + "|".join(map(re.escape, w.split())) + r")\b", re.I) for k, w in WORDS.items()}
_NUMBERS = "token|key|hash|order|invoice|isbn|issn|version|serial|sku|ref|page|id|ticket|case|no|nr|figure|table|population|year"
_DIGESTS = "commit|sha|sha1|sha256|md5|checksum|hash|digest|etag|uuid|revision"
AGAINST = {
    kind: re.compile(rf"\b(?:{_DIGESTS if kind == SECRET else _NUMBERS})\b", re.I) for kind in range(len(KINDS))
}

#: How often a labeler says no, nothing and yes where there is no personal data, and where there is.
#: The words around a candidate (the fourth) say no for few reasons but good ones.
TRUST = np.array([[[0.45, 0.45, 0.10]] * LABELERS, [[0.02, 0.38, 0.60]] * LABELERS])
TRUST[:, 3] = [[0.55, 0.40, 0.05], [0.005, 0.495, 0.50]]
SMOOTHING = 50.0

Span = namedtuple("Span", "kind start end base code")
SPANS = "spans array<struct<kind:int,start:int,end:int,base:boolean,code:int>>"


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The pattern's matches from the left, each found by its @ sign, in linear time."""
    done = 0
    at = text.find("@")
    while at >= 0:
        local = text[done:at]
        start = done + len(local.rstrip(LOCAL))
        found = DOMAIN.match(text, at) if start < at else None
        done = found.end() if found else at + 1
        if found:
            yield start, done
        at = text.find("@", done)


def _written_emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses in which the at sign, a dot or both are written out."""
    done = 0
    for at in AT.finditer(text):
        if at.start() < done:
            continue
        local = text[done : at.start()]
        start = done + len(local.rstrip(LOCAL))
        label = LABEL.match(text, at.end())
        if start == at.start() or label is None:
            continue
        end, dots, written = label.end(), 0, at[0] != "@"
        while True:
            dot = DOT.match(text, end)
            after = dot.end() if dot else end + 1 if text[end : end + 1] == "." else None
            label = LABEL.match(text, after) if after is not None else None
            if label is None:
                break
            end, dots, written = label.end(), dots + 1, written or dot is not None
        if dots and written:
            yield start, end
            done = end


def _groups(found: str) -> list[str]:
    return re.findall("[0-9]+", found)


def _small(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)


def _finds(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """kind, start, end and whether it is a base span; the looser finds among them."""
    if "@" in text:
        yield from ((EMAIL, a, b, True) for a, b in _emails(text))
    if WRITTEN.search(text):
        yield from ((EMAIL, a, b, False) for a, b in _written_emails(text))
    if not re.search("[0-9]", text):
        return
    for m in IP_RE.finditer(text):
        yield IP, *m.span(), _small(m[0].split("."))
    yield from ((IP, *m.span(), False) for m in IP6_RE.finditer(text))
    for m in CARD_RE.finditer(text):
        digits = _digits(m[0])
        good = 16 <= len(digits) <= 19 and luhn(digits)
        if good or 13 <= len(digits) <= 19:
            yield CARD, *m.span(), good
    for m in PHONE_RE.finditer(text) if "+" in text else ():
        if 8 <= len(_digits(m[0])) <= 15:
            yield PHONE, *m.span(), True
    for m in GROUPS.finditer(text):
        if 8 <= len(_digits(m[0])) <= 12 and len(_groups(m[0])) > 1:
            yield PHONE, *m.span(), False
    for m in MIXED.finditer(text):
        digits = len(_digits(m[0]))
        if digits >= 4 and sum(c.isalpha() for c in m[0]) >= 4:
            yield SECRET, *m.span(), False


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """kind, start, end (code points, end exclusive), by kind and start."""
    return sorted((kind, start, end) for kind, start, end, base in _finds(text) if base)


def _phone_shape(found: str) -> int:
    """Which national grouping a number has; 15 if none."""
    groups = _groups(found)
    sizes, first = tuple(map(len, groups)), groups[0]
    if found.startswith("+"):
        return 0
    if sizes == (3, 3, 4):
        return 2 if found.startswith("(") else 1
    if sizes == (2, 2, 2, 2, 2) and first[0] == "0":
        return 3
    if first[0] == "0" and 3 <= sizes[0] <= 5 and len(sizes) <= 4 and 5 <= sum(sizes[1:]) <= 8 and min(sizes) > 1:
        return 4
    if sizes in ((3, 3, 3), (3, 2, 2, 2)) and first[0] in "6789":
        return 5
    return 15


def _phone_votes(found: str, digits: str, shape: int) -> tuple[int, int, int]:
    groups = _groups(found)
    if shape == 0:
        return 1, (1 if 8 <= len(digits) <= 15 else -1), 1
    valid = 1 if 9 <= len(digits) <= 11 else 0 if len(digits) in (8, 12) else -1
    if shape in (1, 2):
        known = 1 if groups[0][0] > "1" and groups[1][0] > "1" else 0 if shape == 2 else -1
    elif shape in (3, 4):
        known = 1 if groups[0][1] != "0" else 0
    else:
        known = -1 if all(g.endswith("00") for g in groups) else 0
    return (-1 if shape == 15 else 1), valid, known


def _email_votes(found: str) -> tuple[int, int, int, int]:
    """Shape and the first three votes."""
    at = AT.search(found)
    local, domain = found[: at.start()], found[at.end() :]
    spelled, bare = DOT.search(domain) is not None, at[0] != "@" and at[0].strip()[0] not in "([{"
    last = LABEL.findall(domain)[-1].lower()
    listed = last in DOMAINS
    form = 1 if not bare else 0 if spelled and "." not in domain and listed else -1
    valid = 1 if listed else 0 if not bare and last.isalpha() and 2 <= len(last) <= 6 else -1
    labels = [x.lower() for x in LABEL.findall(DOT.sub(".", domain))]
    prose = local.lower() in PROSE or not PROSE.isdisjoint(labels[:-1])
    known = -1 if prose else int(any(x in PROVIDERS for x in labels[:-1]))
    return 3 * (2 if bare else int(at[0] != "@")) + int(spelled), form, valid, known


def _secret_votes(found: str) -> tuple[int, int, int, int]:
    groups = [len(g) for g in found.split("-")]
    hexadecimal = re.fullmatch("[0-9a-fA-F]+", found) is not None
    prefixed = found.startswith(PREFIXES)
    size = min(3, len(found) // 16)
    form = 1 if prefixed or hexadecimal and len(found) in (32, 40, 48, 64, 96, 128) else 0
    mixed = len(set(found)) >= 10
    known = 1 if prefixed else -1 if groups == [8, 4, 4, 4, 12] or found.count("-") + found.count("_") > 4 else 0
    return 4 * (prefixed + 2 * hexadecimal) + size, form, (1 if mixed else -1), known


def judged(text: str, kind: int, start: int, end: int, base: bool) -> tuple[tuple[int, ...], int, int]:
    """The votes of the labelers (-1 no, 0 nothing, 1 yes), the shape and the place of a candidate."""
    found = text[start:end]
    digits = _digits(found)
    if kind == EMAIL:
        shape, form, valid, known = _email_votes(found)
        shape = min(shape, 14) if not base else 15
    elif kind == IP:
        four = found.split(".")
        shape, form = len(four) != 4, 1 if base else 0
        valid = 1 if len(four) != 4 or _small(four) else -1
        known = -1 if four[0] in ("0", "255") else 1
    elif kind == CARD:
        shape, form = 2 * (len(digits) - 13) + (len(digits) != len(found)), 1 if base else 0
        valid, known = (1 if luhn(digits) else -1), (1 if digits.startswith(ISSUERS) else -1)
    elif kind == PHONE:
        shape = _phone_shape(found)
        form, valid, known = _phone_votes(found, digits, shape)
    else:
        shape, form, valid, known = _secret_votes(found)
    ahead, after = text[max(0, start - WINDOW) : start], text[end : end + AFTER]
    wanted = BEFORE[kind].search(ahead) is not None
    against = AGAINST[kind].search(ahead) is not None or AGAINST[kind].search(after) is not None
    glued = text[max(0, start - 1) : start].isalnum() or after[:1].isalnum()
    given = ahead.rstrip()[-1:] in ("=", ":", '"', "'")
    context = -1 if against else int(wanted)
    if kind == SECRET:
        beside = int(given)
    else:
        beside = -1 if glued else int(kind != PHONE or given)
    return (form, valid, known, context, beside), min(int(shape), SHAPES - 1), wanted + 2 * against + 4 * given


def encode(kind: int, ballot: tuple[int, ...], shape: int = 0, place: int = 0) -> int:
    code = kind
    for vote in ballot:
        code = code * 3 + vote + 1
    return (code * SHAPES + shape) * PLACES + place


def decode(code: int) -> tuple[int, list[int], int, int]:
    """The inverse of ``encode``, with votes as 0, 1, 2."""
    code, place = divmod(code, PLACES)
    code, shape = divmod(code, SHAPES)
    ballot = []
    for _ in range(LABELERS):
        code, vote = divmod(code, 3)
        ballot.append(vote)
    return code, ballot[::-1], shape, place


def candidates(text: str) -> list[Span]:
    found = []
    for kind, start, end, base in _finds(text):
        ballot, shape, place = judged(text, kind, start, end, base)
        found.append(Span(kind, start, end, base, encode(kind, ballot, shape, place)))
    return found


def aggregate(counts: np.ndarray) -> np.ndarray:
    """Probability that each vote pattern is personal data, by expectation-maximisation."""
    sure = np.zeros(CODES)
    for kind in range(len(KINDS)):
        codes = [c for c in np.flatnonzero(counts).tolist() if decode(c)[0] == kind]
        if not codes:
            continue
        ballots = np.array([decode(c)[1] for c in codes])
        weight = counts[codes].astype(float)
        share, trust = 0.5, TRUST.copy()
        for _ in range(ROUNDS):
            log = np.log([1 - share, share])[:, None] + np.array(
                [sum(np.log(trust[y, j, ballots[:, j]]) for j in range(LABELERS)) for y in (0, 1)]
            )
            good = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
            share = (weight @ good + 1) / (weight.sum() + 2)
            for y, part in enumerate((weight * (1 - good), weight * good)):
                for j in range(LABELERS):
                    seen = np.bincount(ballots[:, j], part, 3) + SMOOTHING * TRUST[y, j]
                    trust[y, j] = seen / seen.sum()
        sure[codes] = good
    return sure


def _features(codes: np.ndarray) -> np.ndarray:
    """For each kind of its own: a constant, every labeler's vote, the shape and the place."""
    width = 1 + 3 * LABELERS + SHAPES + PLACES
    rows = np.zeros((len(codes), len(KINDS) * width))
    for row, code in zip(rows, codes.tolist()):
        kind, ballot, shape, place = decode(code)
        at = kind * width
        row[at] = 1
        for j, vote in enumerate(ballot):
            row[at + 1 + 3 * j + vote] = 1
        row[at + 1 + 3 * LABELERS + shape] = row[at + 1 + 3 * LABELERS + SHAPES + place] = 1
    return rows


def classifier(counts: np.ndarray, steps: int = 30, penalty: float = 0.01) -> np.ndarray:
    """The final classifier's probability for every code, after training on the aggregated votes."""
    codes = np.flatnonzero(counts)
    rows, soft = _features(codes), aggregate(counts)[codes]
    weight = counts[codes] / max(1, counts.sum())
    theta = np.zeros(rows.shape[1])
    for _ in range(steps if len(codes) else 0):
        p = 1 / (1 + np.exp(-np.clip(rows @ theta, -30, 30)))
        slope = rows.T @ (weight * (p - soft)) + penalty * 1e-3 * theta
        curve = (rows * (weight * p * (1 - p))[:, None]).T @ rows
        theta -= np.linalg.solve(curve + (penalty * 1e-3 + 1e-6) * np.eye(len(theta)), slope)
    out = np.zeros(CODES)
    out[codes] = 1 / (1 + np.exp(-np.clip(rows @ theta, -30, 30)))
    return out


def choose(found: list[Span], sure: np.ndarray) -> list[Span]:
    """The base spans and the added ones, by kind and start."""
    taken = [s for s in found if s.base]
    # Starts and ends of the text that is taken, in order and apart from each other.
    starts, ends = [], []
    for span in sorted(taken, key=lambda s: s.start):
        if ends and span.start < ends[-1]:
            ends[-1] = max(ends[-1], span.end)
        else:
            starts.append(span.start)
            ends.append(span.end)
    likely = [s for s in found if not s.base and sure[s.code] >= THRESHOLD]
    for span in sorted(likely, key=lambda s: (-sure[s.code], s.start)):
        at = bisect_right(ends, span.start)
        if at == len(starts) or starts[at] >= span.end:
            starts.insert(at, span.start)
            ends.insert(at, span.end)
            taken.append(span)
    return sorted(taken, key=lambda s: (s.kind, s.start))


def find(docs: DataFrame) -> DataFrame:
    """doc_id and the candidates of every document."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct(
            [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("code", pa.int32())]
        )
        for batch in batches:
            spans = [[s._asdict() for s in candidates(t.as_py() or "")] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(kind))], ["doc_id", "spans"])

    return common.take(docs, "doc_id", "text").mapInArrow(search, f"doc_id long, {SPANS}")


def fit(found: DataFrame) -> np.ndarray:
    """The classifier's probabilities by code, from the votes of all documents."""
    counts = np.zeros(CODES, np.int64)
    for code, n in found.select(F.explode("spans.code").alias("code")).groupBy("code").count().collect():
        counts[code] = n
    return classifier(counts)


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, spans: the spans of every document; ``base`` marks those of the fixed patterns."""
    found = store.materialise(find(docs), "candidates")
    sure = fit(found)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [s._asdict() for s in choose([Span(**s) for s in row], sure)]
                for row in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, batch.column(1).type)], ["doc_id", "spans"]
            )

    return found.mapInArrow(select, f"doc_id long, {SPANS}")


def mask(text: str, spans: list[Span]) -> str:
    """The text with ``[KIND]`` in place of every span; overlapping ones become the first's."""
    parts, done = [], 0
    for span in sorted(spans, key=lambda s: (s.start, -s.end)):
        if span.start >= done:
            parts += [text[done : span.start], f"[{KINDS[span.kind].upper()}]"]
        done = max(done, span.end)
    return "".join([*parts, text[done:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with its spans masked in ``text`` and, where there is one, ``n_chars`` counted anew.

    All rows and all other columns stay; a NULL text stays NULL.
    """
    sure = fit(store.materialise(find(docs), "candidates"))
    plain, (text,) = common.plain(docs, "text")
    at = plain.columns.index(text)
    counted = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                t if t is None else mask(t, choose(candidates(t), sure))
                for t in batch.column(at).to_pylist()
            ]
            columns = [*batch.columns]
            columns[at] = pa.array(texts, batch.column(at).type)
            if counted is not None:
                sizes = batch.column(counted).to_pylist()
                sizes = [n if t is None else len(t) for t, n in zip(texts, sizes)]
                columns[counted] = pa.array(sizes, batch.column(counted).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return common.named(plain.mapInArrow(rewrite, plain.schema), docs)
