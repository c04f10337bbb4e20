"""Collocations against counts of everything, and the passes of the mining one by one."""

import random
import re
from collections import Counter

import pytest

from tallyloom.llm import collocations

from .conftest import ROWS


def brute_counts(rows):
    counts = Counter()
    for lang, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts[lang or "und", tuple(words[i : i + size])] += 1
    return counts


def brute(rows, least=10, inside=50, first=2000):
    counts = brute_counts(rows)
    total = Counter()
    for (lang, words), n in counts.items():
        total[lang] += n if len(words) == 1 else 0
    candidates = {k: n for k, n in counts.items() if len(k[1]) > 1 and n >= least}
    covered = {}
    for (lang, words), n in candidates.items():
        for part in (words[:2], words[1:]) if len(words) == 3 else ():
            covered[lang, part] = max(n, covered.get((lang, part), 0))
    found = []
    for (lang, words), a in candidates.items():
        if 100 * covered.get((lang, words), 0) >= inside * a:
            continue
        cuts = [(counts[lang, words[:k]], counts[lang, words[k:]], k) for k in range(1, len(words))]
        score, k, left, right = min((1000000 * a * a // (x * y), k, x, y) for x, y, k in cuts)
        found.append((lang, -score, -a, " ".join(words).encode(), left, right))
    out, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(found):
        rank[lang] += 1
        if rank[lang] <= first:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, total[lang], -score))
    return out


def made(spark, rows):
    return spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")


def zipf(rng, count, words, size):
    vocabulary = [f"w{i}" if i % 7 else f"É{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    signs = ["", "", "", "", ",", ".", " \t", "\n"]
    return [
        (rng.choice(["en", "fr", None]), " ".join(w + rng.choice(signs) for w in rng.choices(vocabulary, weights, k=size)))
        for _ in range(count)
    ]


@pytest.mark.parametrize("block", [collocations.BLOCK, 37])
def test_against_counting_everything(spark, odd, monkeypatch, block):
    monkeypatch.setattr(collocations, "BLOCK", block)
    monkeypatch.setattr(collocations, "PART", min(block, collocations.PART))
    rows = zipf(random.Random(1), 150, 60, 60) + [(None, "")] * 3
    rows += [("en", "New York City, NEW YORK CITY! new york")] * 12
    got = [tuple(r) for r in collocations.collocations(made(spark, rows)).collect()]
    assert sorted(got) == sorted(brute(rows))
    assert any(len(p.split()) == 3 for _, _, p, *_ in got)


@pytest.mark.parametrize("share", [0.0, 0.02, 0.3, 1.0])
def test_failures_of_the_sample_are_made_good(spark, odd, share):
    """With a bad sample, too, every frequent phrase is counted exactly."""
    rows = zipf(random.Random(2), 100, 40, 50)
    got = collocations.frequent(made(spark, rows), share=share)
    got = {(r["lang"], tuple(r["phrase"].split(" "))): r["n"] for r in got.collect() if r["phrase"]}
    assert got == {k: n for k, n in brute_counts(rows).items() if n >= 10}


def test_border_is_counted_and_no_more(spark, odd):
    """The first full pass holds pairs of proposed words and triples of proposed pairs only, the next
    one what was found frequent beyond them."""
    rows = [("en", "a b c")] * 3 + [("en", "a b d, e f g")]
    docs = made(spark, rows).select("lang", "text")

    def proposals(*phrases):
        table = spark.createDataFrame([("en", p) for p in phrases], "lang string, phrase string")
        return collocations._proposals(collocations._phrase_hashes(table))

    def got(*which):
        return {r["phrase"]: r["n"] for r in collocations.exact_counts(docs, *which).collect()}

    sample = proposals("a", "b", "c", "a b", "b c")
    words = {"a": 4, "b": 4, "c": 3, "d": 1, "e": 1, "f": 1, "g": 1, "": 15}
    assert got(sample) == words | {"a b": 4, "b c": 3, "a b c": 3}
    assert got(sample, proposals("a", "b", "c", "d", "a b", "b c")) == {"b d": 1, "a b d": 1}
    assert got(sample, proposals("a", "b", "c", "a b", "b c")) == {}


def test_full_tables_change_nothing(spark, odd, monkeypatch):
    monkeypatch.setattr(collocations, "FEWEST_BITS", 64)
    monkeypatch.setattr(collocations, "MOST_BITS", 64)
    rows = zipf(random.Random(3), 80, 40, 50)
    got = [tuple(r) for r in collocations.collocations(made(spark, rows)).collect()]
    assert sorted(got) == sorted(brute(rows))


def test_products_beyond_64_bits(spark, odd):
    n = 5 * 10**12
    counts = [("en", "", 9 * n), ("en", "a", 3 * n), ("en", "b", 2 * n), ("en", "a b", n)]
    rows = collocations.ranked(spark.createDataFrame(counts, "lang string, phrase string, n long")).collect()
    assert [tuple(r) for r in rows] == [("en", 1, "a b", n, 3 * n, 2 * n, 9 * n, 166666)]


def test_first_of_each_language_and_ties(spark, odd):
    rows = [("en", "b a, d c")] * 10 + [("en", "f e")] * 11 + [("fr", "x y")] * 10
    got = [tuple(r)[:3] for r in collocations.collocations(made(spark, rows), first=2).collect()]
    assert sorted(got) == [("en", 1, "f e"), ("en", 2, "b a"), ("fr", 1, "x y")]


def test_odd_rows_and_empty_table(odd, nothing):
    rows = [(r[2], r[1]) for r in ROWS]
    assert sorted(tuple(r) for r in collocations.collocations(odd).collect()) == sorted(brute(rows))
    assert collocations.collocations(nothing).count() == 0
