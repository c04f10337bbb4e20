"""The three token operators against the libraries."""

import base64
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tallyloom import store
from tallyloom.llm import bpe, catalogue, packing, records, tokens
from tallyloom.llm.tokens import WordTokens, word_tokens

from .conftest import ROWS

WORDS, BYTES = catalogue.WORDS, catalogue.BYTES
LIBRARY = Tokenizer.from_file(WORDS)
BITS = (
    "a B 's 'LL 1 é É é ́ ß İ Σ ς <|endoftext|> <| |> _ - 😀 ‍ 中 ﬁ ½ ٣ ' zz tion".split()
    + [" ", "  ", "\n", "\x1c", "\xa0", " ", "\x00", "\x7f", "\x85"]
)
TEXTS = [None, "", *(r[1] for r in ROWS if r[1])]


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def as_ints(data):
    return np.frombuffer(data, "<u4").tolist()


def test_word_ids_are_those_of_the_library():
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choices(BITS, k=rng.randint(0, 12))) for _ in range(3000)]
    got = [ids.tolist() for ids in word_tokens(WORDS).encode(pa.array(texts))]
    assert got == [library_ids(t) for t in texts]


RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTES, "rb"))}
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.encoder(BYTES, public_tokenizers.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("ae th's\n  1")), max_size=40))
def test_byte_ids_are_those_of_the_library(text):
    words = bpe.encoder(BYTES, public_tokenizers.PATTERN)
    ids = words.encode(text)
    assert as_ints(ids) == TIKTOKEN.encode_ordinary(text)
    assert words.decode(ids) == text.encode()


def test_appending_and_editing_give_the_encoding_of_the_whole(encoder):
    rng = random.Random(2)
    for _ in range(100):
        data = "".join(rng.choices("etaoinshr dlu", k=30)).encode()
        cut, new = rng.randint(0, 30), "".join(rng.choices("etaoin", k=5)).encode()
        grown = bpe.Prefixes(encoder.vocabulary, data[:cut])
        grown.append(data[cut:])
        assert grown.tokens() == bpe.Prefixes(encoder.vocabulary, data).tokens()
        assert grown.tokens() == [RANKS[t] for t in bpe.merge(data, RANKS)]
        grown.replace(cut // 2, cut, new)
        edited = data[: cut // 2] + new + data[cut:]
        assert grown.tokens() == [RANKS[t] for t in bpe.merge(edited, RANKS)]


def test_an_edit_leaves_what_follows_alone(encoder):
    rng = random.Random(3)
    data = "".join(rng.choices("etaoinshr dlu", k=20_000)).encode()
    edited = bpe.Prefixes(encoder.vocabulary, data)
    asked, one = [], edited._last_token
    edited._last_token = lambda end: asked.append(end) or one(end)
    edited.replace(10_000, 10_003, b"quick")
    whole = bpe.Prefixes(encoder.vocabulary, data[:10_000] + b"quick" + data[10_003:])
    assert (edited.data, edited.last) == (whole.data, whole.last)
    assert len(asked) < 10 * encoder.vocabulary.longest


def test_a_long_run_without_spaces(encoder):
    text = "ab" * 5000
    assert as_ints(encoder.encode(text)) == TIKTOKEN.encode_ordinary(text)


def test_long_runs_stay_out_of_the_tables():
    rng = random.Random(4)
    runs = ["".join(rng.choices("abcdefgh", k=100_000)) for _ in range(4)]
    words, parts = WordTokens(WORDS), bpe.Encoder(BYTES, public_tokenizers.PATTERN)
    got = [ids.tolist() for ids in words.encode(pa.array([f"a {r} b" for r in runs]))]
    assert got == [library_ids(f"a {r} b") for r in runs]
    assert max(map(len, words.known)) <= tokens.KNOWN_SIGNS
    for run in runs[:1]:
        assert as_ints(parts.encode(f"a {run} b")) == TIKTOKEN.encode_ordinary(f"a {run} b")
    assert max(map(len, [*parts.parts, *parts.pieces])) <= bpe.KEPT_SIGNS


def test_byte_encoding_of_odd_rows(odd, nothing):
    rows = bpe.encode(odd, BYTES, public_tokenizers.PATTERN).collect()
    got = sorted(((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in rows), key=repr)
    want = ((r[0], TIKTOKEN.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in ROWS)
    assert got == sorted(want, key=repr)
    assert bpe.encode(nothing, BYTES, public_tokenizers.PATTERN).count() == 0


@pytest.fixture(scope="module")
def written(spark, odd):
    path = store.new_path(spark, "test-records")
    records.write(odd, path, WORDS, end=2, shard_bytes=50_000)
    return path


def expected_records():
    ordered = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    before, out = 0, []
    for r in ordered:
        ids = [*library_ids(r[1]), 2]
        out.append((r[0], before, ids))
        before += len(ids)
    return out


def test_records_come_back_in_order(spark, written):
    rows = records.read(spark, written).drop("n_tokens").join(records.index(spark, written), ["shard", "record", "doc_id"], "left")
    starts = {(r["shard"], r["record"]): r for r in records.index(spark, written).collect()}
    rows = sorted(records.read(spark, written).collect(), key=lambda r: (r["shard"], r["record"]))
    got = [(r["doc_id"], starts[r["shard"], r["record"]]["start"], as_ints(r["ids"])) for r in rows]
    assert got == expected_records()
    assert len({r["shard"] for r in rows}) > 1


def test_rows_of_one_id_lie_in_many_shards(spark, odd):
    """A third of the rows have one id, and some of these are alike; another third have none."""
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else i, f"word{i // 9} again and again") for i in range(600)]
    path = store.new_path(spark, "test-hot-records")
    records.write(spark.createDataFrame(rows, "doc_id long, text string"), path, WORDS, end=2, shard_bytes=1_000)
    got = sorted(records.read(spark, path).collect(), key=lambda r: (r["shard"], r["record"]))
    hot = {r["shard"] for r in got if r["doc_id"] == 7}
    assert len(hot) > 3 and len({r["shard"] for r in got if r["doc_id"] is None}) > 3
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    want = sorted(((i, [*library_ids(t), 2]) for i, t in rows), key=repr)
    assert sorted(((r["doc_id"], as_ints(r["ids"])) for r in got), key=repr) == want
    starts = {(r["shard"], r["record"]): r["start"] for r in records.index(spark, path).collect()}
    before = 0
    for r in got:
        assert starts[r["shard"], r["record"]] == before
        before += r["n_tokens"]


def test_index_finds_each_record(spark, written):
    shuffled = records.shuffled(spark, written, seed=7)
    again = [r["position"] for r in records.shuffled(spark, written, seed=7).collect()]
    rows = shuffled.collect()
    assert [r["position"] for r in rows] == again == sorted(again)
    got = sorted(((r["doc_id"], as_ints(r["ids"])) for r in rows), key=repr)
    assert got == sorted(((d, ids) for d, _, ids in expected_records()), key=repr)
    assert [r["position"] for r in records.shuffled(spark, written, seed=8).collect()] != again


def test_damage_is_noticed():
    data = records.frame(5, np.array([1, 70000], "<u4")) + b"\n"
    assert records.parse(memoryview(data), 0)[1].tolist() == [1, 70000]
    for at in range(len(data)):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            records.parse(memoryview(bytes(broken)), 0)
    with pytest.raises(ValueError):
        records.parse(memoryview(data[:-3]), 0)


def test_empty_records(spark, nothing):
    path = store.new_path(spark, "test-no-records")
    records.write(nothing, path, WORDS, end=2)
    assert records.read(spark, path).count() == records.index(spark, path).count() == 0


def check_packed(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_packing_of_odd_rows(odd, nothing):
    rows = packing.pack(packing.pieces(odd, WORDS, end=0)).collect()
    want = []
    for r in ROWS:
        ids = [*library_ids(r[1]), 0]
        for i, start in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[start : start + 2048], "<u4")
            want.append((r[0], i, start, len(part), zlib.crc32(part.tobytes())))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(bytes(r["ids"]))) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert check_packed(rows, 2048) == -(-sum(r["length"] for r in rows) // 2048)
    assert packing.pack(packing.pieces(nothing, WORDS, end=0)).count() == 0


def histograms():
    rng = np.random.default_rng(0)
    few = np.zeros(101, int)
    few[[54, 44, 34, 33, 21, 20]] = [50, 30, 40, 10, 7, 200]
    yield "few", few
    for low, high in ((1, 101), (20, 45), (30, 51), (51, 101)):
        yield f"{low}-{high}", np.bincount(rng.integers(low, high, 600), minlength=101)
    yield "one", np.bincount([70], minlength=101)
    yield "none", np.zeros(101, int)


@pytest.mark.parametrize("name,demand", list(histograms()))
def test_plan_covers_demand_with_few_bins(name, demand):
    plan = packing.plan(demand, 100)
    covered = np.zeros(101, int)
    for content, times in plan:
        assert times > 0 and sum(n * m for n, m in content.items()) <= 100
        for n, m in content.items():
            covered[n] += m * times
    assert (covered == demand).all()
    plain = sum(t for _, t in packing.best_fit(demand, 100))
    assert sum(t for _, t in plan) <= plain
    if demand.any():
        _, bound = packing.weights(demand, 100)
        assert bound <= sum(t for _, t in plan) + 1e-6


def test_knapsack_is_exact():
    price = np.zeros(21)
    price[[3, 5, 7]] = [3.1, 5.6, 7.5]
    best, _ = packing.knapsack(price, 20)
    for space in range(21):
        every = [
            3.1 * a + 5.6 * b + 7.5 * c
            for a in range(7) for b in range(5) for c in range(3) if 3 * a + 5 * b + 7 * c <= space
        ]
        assert best[space] == pytest.approx(max(every))


def test_the_table_counts_each_run_once():
    """A run that is one piece takes one entry and its bytes once, so the table holds more of them."""
    words = WordTokens(WORDS)
    texts = pa.array(["hello world", "hello, straße! 12", "it's a hello-world world"])
    want = [Tokenizer.from_file(WORDS).encode(t, add_special_tokens=False).ids for t in texts.to_pylist()]
    assert [ids.tolist() for ids in words.encode(texts)] == want
    held = sum(tokens.ENTRY_BYTES + len(run) + len(ids) for run, ids in words.known.items())
    assert words.held == held
