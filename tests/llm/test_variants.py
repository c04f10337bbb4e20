"""Spelling variants against the full edit matrix and plain counting."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyloom.llm import catalogue, variants

from .conftest import ROWS


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y)))
    return row[-1] == 1


def brute_words(rows, typos=True):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if typos and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def brute(rows, typos=True):
    words = brute_words(rows, typos)
    near, form = {}, {}
    for word, n in words.items():
        near[word] = [w for w in words if one_edit(word, w)]
        best = min(near[word], key=lambda w: (-words[w], w), default=None)
        form[word] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for word, n in words.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out.append((word, form[word], root, n, len(near[word]), words.get(form[word])))
    return sorted(out)


def got(rows):
    assert rows.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in rows.collect())


def edited(rng, word):
    place, sign = rng.randrange(len(word) + 1), rng.choice("aeé")
    return rng.choice([word[:place] + sign + word[place:], word[:place] + word[place + 1 :], word[:place] + sign + word[place + 1 :]])


def made_words(seed, families):
    rng, words = random.Random(seed), set()
    for _ in range(families):
        word = "".join(rng.choices("aeinrst", k=rng.randrange(6, 12)))
        for _ in range(rng.randrange(1, 9)):
            words.add(word)
            word = edited(rng, word)
    return sorted(words)


@pytest.mark.parametrize("seed", range(4))
def test_scan_finds_one_edit_and_no_other(seed):
    words = [w for w in made_words(seed, 40) if w]
    asked, listed = words[::2], words
    shared = [0, *variants.shared_prefixes(listed).tolist()]
    a, b = variants.Scan(asked).near(np.arange(len(asked)), listed, shared, False)
    pairs = [(asked[i], listed[j]) for i, j in zip(a.tolist(), b.tolist())]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(x, y) for x in asked for y in listed if one_edit(x, y)}


@pytest.mark.parametrize("words", [["a"], ["a", "aa"], ["ab", "b"], ["abc", "acb"], ["", "a"], ["é", "e"], ["ab", "abcdefgh"]])
def test_scan_at_the_edges(words):
    words = sorted(words)
    shared = [0, *variants.shared_prefixes(words).tolist()]
    a, b = variants.Scan(words).near(np.arange(len(words)), words, shared, True)
    assert {(words[i], words[j]) for i, j in zip(a, b)} == {(y, x) for x in words for y in words if x < y and one_edit(x, y)}


@pytest.mark.parametrize("block", [variants.BLOCK, 5])
def test_neighbours_of_all_groups_and_blocks(spark, odd, monkeypatch, block):
    monkeypatch.setattr(variants, "BLOCK", block)
    words = [w for w in made_words(7, 60) if len(w) >= 7]
    table = spark.createDataFrame([(w, i + 2) for i, w in enumerate(words)], "word string, n long")
    rows = [tuple(r) for r in variants.neighbours(table).collect()]
    count = {w: i + 2 for i, w in enumerate(words)}
    assert sorted(rows) == sorted((x, y, count[y]) for x in words for y in words if one_edit(x, y))


def test_whole_groups_over_several_tables(spark, odd, monkeypatch):
    monkeypatch.setattr(variants, "ROWS", 3)
    words = [w for w in made_words(8, 25) if len(w) >= 7]
    table = spark.createDataFrame([(w, 2) for w in words], "word string, n long").coalesce(1)
    rows = [tuple(r)[:2] for r in variants.neighbours(table).collect()]
    assert sorted(rows) == sorted((x, y) for x in words for y in words if one_edit(x, y))


def test_forms_and_roots(spark, odd):
    """A chain over three words, ties between forms, and counts just under the limit."""
    words = {"lettera": 2, "letterab": 20, "letterabc": 200, "letterabcd": 2000}
    words |= {"planets": 2, "planetz": 20, "planeta": 20, "bridges": 2, "bridgez": 19}
    text = " ".join(f"{w.capitalize()}, " * n for w, n in words.items())
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = {r["word"]: r for r in variants.variants(docs, typos=False).collect()}
    assert [rows[w]["form"] for w in list(words)[:4]] == ["letterab", "letterabc", "letterabcd", None]
    assert {rows[w]["root"] for w in list(words)[:4]} == {"letterabcd"}
    assert rows["planets"]["form"] == "planeta" and rows["planets"]["n_near"] == 2
    assert rows["bridges"]["form"] is None and rows["bridges"]["root"] == "bridges"
    assert got(variants.variants(docs, typos=False)) == brute([(1, text)], typos=False)


def test_documents_with_typos(spark, odd):
    rng = random.Random(9)
    words = made_words(10, 30) + ["ÀÉÎÕÜ×÷ß", "Straßenbahnen", "x" * 300]
    rows = [(rng.choice([None, i]), " ".join(rng.choices(words, k=300)) + "¡don't-Stopping") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(variants.variants(docs)) == brute(rows)


def test_odd_rows_and_empty_table(odd, nothing):
    assert got(variants.variants(odd)) == brute([r[:2] for r in ROWS])
    assert got(variants.variants(nothing)) == []


def test_query_on_the_small_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    words = brute_words([tuple(r) for r in docs])
    rows = {r["word"]: r for r in catalogue.QUERIES["op12_spelling_variants"](spark, small).collect()}
    assert {w: r["n"] for w, r in rows.items()} == words
    for word in random.Random(1).sample(sorted(words), 60):
        near = [w for w in words if one_edit(word, w)]
        assert rows[word]["n_near"] == len(near)
        best = min(near, key=lambda w: (-words[w], w), default=None)
        assert rows[word]["form"] == (best if best and words[best] >= 10 * words[word] else None)
