"""Learned operators: exact parts against brute force, learned parts by held-out results."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from __spark_entry__ import queries
from tallyloom.llm import catalogue, language_mix, quality, url_filter
from tallyloom.llm.common import fold
from pyspark.sql import functions as F

from .conftest import ROWS


def remainder(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


@pytest.fixture(scope="module")
def judged(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    languages = language_mix.fit(docs, fold(F.col("doc_id"), 4) != 2)
    return docs, languages


def test_languages_of_held_out_documents(spark, medium):
    rows = {r["doc_id"]: r for r in queries()["op4_language"](spark, medium).collect()}
    docs = spark.read.parquet(f"{medium}/documents.parquet").collect()
    assert len(rows) == len(docs)
    held = [d for d in docs if remainder(d["doc_id"], 4) == 2]
    assert all(rows[d["doc_id"]]["held_out"] == (d in held) for d in docs[:200])
    right = sum(rows[d["doc_id"]]["lang_pred"] == d["lang"] for d in held)
    assert right / len(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_language_learns_from_the_allowed_rows_only(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    wrong = docs.withColumn("lang", F.when(fold(F.col("doc_id"), 4) == 2, F.lit("xx")).otherwise(F.col("lang")))
    usable = fold(F.col("doc_id"), 4) != 2
    a, b = language_mix.fit(docs, usable), language_mix.fit(wrong, usable)
    assert a.names == b.names and (a.logs == b.logs).all()


def test_a_mixed_text_has_both_languages(judged):
    docs, languages = judged
    long = docs.where(F.length("text") > 3000).orderBy("doc_id")
    one, other = (long.where(F.col("lang") == lang).first()["text"][:1500] for lang in ("en", "de"))
    lang, score, mix = language_mix.judge(one + " " + other, languages)
    assert set(mix) == {"en", "de"} and 0.3 < mix["en"] < 0.7 and score == max(mix.values())
    assert set(language_mix.judge(one, languages)[2]) == {"en"}


def test_texts_of_four_equal_parts_are_kept(spark, judged):
    docs, languages = judged
    long = docs.where(F.length("text") > 1000).orderBy("doc_id").select("lang", "text").collect()
    parts = [[r["text"][:500] for r in long if r["lang"] == lang][:20] for lang in ("en", "fr", "de", "es")]
    mixed = [" ".join(texts) for texts in zip(*parts)]
    assert len(mixed) == 20
    assert sum(language_mix.judge(text, languages)[1] < 0.3 for text in mixed) > 0
    rows = spark.createDataFrame([*enumerate(mixed)], "doc_id long, text string")
    assert sorted(language_mix.keep(rows, languages).collect()) == sorted(rows.collect())


def test_languages_that_were_not_learned_go_and_missing_ones_are_filled(spark, judged, medium):
    languages = judged[1]
    greek = "Τα παιδιά παίζουν στην αυλή του σχολείου κάθε πρωί πριν αρχίσει το μάθημα"
    noise = "zqxjkvbwpfgh qzxkvjwq bnvczxqj wqzxkjvb qqzzxxjj kkvvbbww xzqjwkvb"
    short = "Γεια σου"
    texts = {r["doc_id"]: r for r in spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text", "lang").collect()}
    known = [(r["doc_id"], r["text"], r["lang"] if r["doc_id"] % 2 else None) for r in texts.values()]
    rows = [*known, (-1, greek, "el"), (-2, noise, None), (-3, short, None), (-4, short, "el"), (-5, "123", None)]
    kept = language_mix.keep(spark.createDataFrame(rows, "doc_id long, text string, lang string"), languages)
    kept = {r["doc_id"]: r["lang"] for r in kept.collect()}
    assert {i for i in kept if i < 0} == {-3, -4} and kept[-4] == "el" and kept[-3] in languages.names
    letters = {i for i, r in texts.items() if any(c.isalpha() for c in r["text"])}
    assert {i for i in kept if i >= 0} == letters
    assert sum(kept[i] == texts[i]["lang"] for i in letters) >= 0.99 * len(letters)



def test_shares_are_those_of_plain_expectation_maximisation():
    rng = np.random.default_rng(1)
    likely, counts = rng.random((20, 3)), rng.integers(1, 9, 20)
    share = [1 / 3] * 3
    for _ in range(language_mix.STEPS):
        new = [0.0] * 3
        for row, n in zip(likely, counts):
            mixed = [p * s for p, s in zip(row, share)]
            for i, m in enumerate(mixed):
                new[i] += n * m / sum(mixed)
        share = [x / counts.sum() for x in new]
    assert language_mix.shares(likely, counts)[0] == pytest.approx(share)


def test_slots_ignore_case_digits_and_runs_of_other_signs():
    assert (language_mix.slots("Ab, 12 c") == language_mix.slots("aB -- C")).all()
    assert len(language_mix.slots("12 !?")) == len(language_mix.slots(None)) == 0
    assert len(language_mix.slots("中文 𝒳")) > 0


def test_language_of_odd_rows(odd, nothing, judged):
    _, languages = judged
    rows = language_mix.detect(odd, languages).collect()
    und = sorted((r["doc_id"] for r in rows if r["lang_pred"] == "und"))
    assert und == [3, 4, 5, 6] and all(r["score"] == 0 for r in rows if r["lang_pred"] == "und")
    assert len(rows) == len(ROWS)
    kept = language_mix.keep(odd, languages)
    assert kept.columns == odd.columns and kept.count() == len(ROWS) - 4
    assert language_mix.detect(nothing, languages).count() == 0
    none = language_mix.fit(nothing, F.lit(True))
    assert {r["lang_pred"] for r in language_mix.detect(odd, none).collect()} == {"und"}
    assert language_mix.fit(odd, F.lit(True)).names == ["en", "fr"]


def auc(pairs):
    ones = [s for s, y in pairs if y]
    zeros = [s for s, y in pairs if not y]
    return sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros))


def test_quality_of_held_out_documents(spark, medium):
    rows = {r["doc_id"]: r for r in queries()["op3_quality"](spark, medium).collect()}
    labels = spark.read.parquet(f"{medium}/labels.parquet").collect()
    assert len(rows) == spark.read.parquet(f"{medium}/documents.parquet").count()
    held = [r for r in labels if remainder(r["doc_id"], 3) == 1]
    assert all(rows[r["doc_id"]]["held_out"] for r in held)
    assert auc([(rows[r["doc_id"]]["score"], r["quality"]) for r in held]) > 0.97
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows.values())


def test_quality_score_is_the_sparse_dot_product():
    import pyarrow as pa

    weights = np.random.default_rng(0).normal(size=quality.WIDTH).astype("<f4")
    texts = [None, "", "A b", "One two two, TWO! x9", "word " * 300]
    words = quality.Words()
    got = quality.scores(pa.array(texts), weights, words)
    for text, score, (slots, values) in zip(texts, got, quality.features(pa.array(texts), words)):
        assert score == pytest.approx(1 / (1 + math.exp(-float(weights[slots] @ values))), rel=1e-4)
        assert len(set(slots.tolist())) == len(slots)
    assert got[0] == got[1]


def test_forms():
    assert [quality.form(w) for w in ("ab", "Ab", "AB", "A", "Ab,c3", "###")] == ["x", "Xx", "X", "Xx", "Xx,x0", "#"]


def test_leader_matches_the_published_update():
    leader = quality.Leader()
    z, n, a, b = Counter(), Counter(), quality.ALPHA, quality.BETA

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        return -math.copysign(abs(z[i]) - quality.L1, z[i]) / ((b + math.sqrt(n[i])) / a + quality.L2)

    rng = np.random.default_rng(3)
    for _ in range(50):
        slots = np.sort(rng.choice(20, 5, replace=False))
        values, label = rng.random(5), int(rng.integers(0, 2))
        held = {i: weight(i) for i in slots}
        p = 1 / (1 + math.exp(-sum(held[i] * x for i, x in zip(slots, values))))
        for i, x in zip(slots, values):
            g = (p - label) * x
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / a * held[i]
            n[i] += g * g
        leader.learn(slots, values, label)
    assert leader.weights(np.arange(20)) == pytest.approx([weight(i) for i in range(20)])


def test_quality_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (7, 1), (8, 0), (3, 1), (11, None), (99, 1), (None, 1), (1, 1)], "doc_id long, label int"
    )
    weights = quality.fit(odd, labels, F.lit(True))
    rows = quality.score(odd, weights).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (3, 4, 5)}
    assert len(empty) == 1
    assert quality.score(nothing, weights).count() == 0
    none = quality.fit(odd, labels.limit(0), F.lit(True))
    assert {r["score"] for r in quality.score(odd, none).collect()} == {0.5}


URLS = [
    (1, "http://A.Example.ORG/es/x", "example.org", "/es/x"),
    (2, "https://example.org/en/12?q", "example.org", "/en/12"),
    (3, "https://badexample.org/es/", "badexample.org", "/es/"),
    (4, "https://x.com/fr/1#t", "x.com", "/fr/1"),
    (5, "https://com/de/", "com", "/de/"),
    (6, "https://example.org", "example.org", ""),
    (7, "https://example.org?x=/es/", "example.org", ""),
    (8, "no scheme", "", ""),
    (9, None, "", ""),
    (10, "", "", ""),
    (11, "a://b://c/d", "b:", "//c/d"),
    (12, "x://É.org\n/p", "É.org\n", "/p"),
    (12, "x://É.org\n/p", "É.org\n", "/p"),
    (None, "https://casino.example.net/" + "z" * 100_000, "casino.example.net", "/" + "z" * 100_000),
]
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def brute_rule(host, path):
    fits = [
        (len(h + p), h + p, v)
        for v, h, p in RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else (None, None)


def test_urls(spark, odd):
    pages = spark.createDataFrame([(i, u, "h", 1) for i, u, _, _ in URLS], "page_id long, url string, host string, URL int")
    rules = url_filter.rules(catalogue.URL_RULES)
    rows = url_filter.judge(pages, rules, catalogue.labelled_urls(spark), "page_id").collect()
    assert len(rows) == len(URLS)
    got = sorted(((r["page_id"], r["host"], r["path"], r["rule"]) for r in rows), key=repr)
    want = [(i, ("a." if i == 1 else "") + h, p) for i, _, h, p in URLS]
    want = [(i, h.replace("a.example", "a.example"), p, brute_rule(h, p)[0]) for i, h, p in want]
    assert got == sorted(want, key=repr)
    for r in rows:
        if r["rule"] is not None:
            assert r["verdict"] == brute_rule(r["host"], r["path"])[1] and r["score"] is None
        else:
            assert r["verdict"] == ("block" if r["score"] >= 0.5 else "allow")
    none = url_filter.judge(pages, rules, catalogue.labelled_urls(spark).limit(0), "page_id")
    assert {r["verdict"] for r in none.where("rule is null").collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0), rules, catalogue.labelled_urls(spark), "page_id").count() == 0


def test_url_regression_blocks_hosts_like_the_labelled_ones(spark, medium):
    rows = queries()["op6_url_filter"](spark, medium).where("rule is null").collect()
    bad = ("casino", "free-bets", "adult-x", "cheap-pills", "spam-farm", "ads-track")
    marked = [(any(b in r["host"] for b in bad), r["verdict"] == "block") for r in rows]
    assert all(blocked for is_bad, blocked in marked if is_bad)
    clean = [blocked for is_bad, blocked in marked if not is_bad]
    assert sum(clean) / len(clean) < 0.1


# None of these names is one of the labelled hosts, and none was looked at when those were chosen.
BAD_HOSTS = """
casinopalace grand-casinos poker-room pokerclub betcity betting-tips livebets slotmania megaslots
jackpot-party roulette-king bingohall lotteryticket gamblezone blackjacktable adultvideo adult-chat
pornstars sextube sexdolls xxxclips nudegirls eroticstories escortlady hookupnow buy-viagra pillsdirect
cialisonline steroidshop spambot spam-list linkfarmers clickbaiter adsnetwork bannerclicks tracker-hub
popupads malwares phishingkit warezone crackz torrents-hub getrichfast replicabags scammers fraudsters
"""
CLEAN_HOSTS = """
riverside-school oldmuseum citylibraries weatherstation travelnotes gardenershop musiclessons bookclub
filmreview theatregroup sciencefair historywalk physicsworld hospitaltrust posters trainspotter airportbus
sportsday footballfans tennisclub chessmaster photographers designers mapmaker helpdesk jobsearch
calendars archives researcher magazines radiohall televisions cinema bakehouse pottery weaving stamps
castles robotics geology botany zoology sussex wessex sextant assessment classics padstow adsorption
alphabetical betony scrapbook trackers-guide backtrack cracker-recipes banneker casein peppills
"""


def labels_of(hosts):
    return {label for host in hosts for label in host.split(".")} - {"com", "org", "net", "www", ""}


def test_url_regression_learns_from_hosts_other_than_the_given_ones(spark, medium):
    labelled = catalogue.labelled_urls(spark)
    names = labels_of(r["host"] for r in url_filter.parts(labelled).select("host").distinct().collect())
    given = url_filter.parts(spark.read.parquet(f"{medium}/pages.parquet")).select("host").distinct().collect()
    assert not names & labels_of(r["host"] for r in given)
    kinds = [(host, bad) for bad, hosts in enumerate((CLEAN_HOSTS, BAD_HOSTS)) for host in hosts.split()]
    assert not names & {host for host, _ in kinds}
    urls = spark.createDataFrame([(i, f"https://{h}.com/") for i, (h, _) in enumerate(kinds)], "page_id long, url string")
    rows = url_filter.judge(urls, [], labelled, "page_id").collect()
    blocked = [[], []]
    for r in rows:
        blocked[kinds[r["page_id"]][1]].append(r["verdict"] == "block")
    assert sum(blocked[1]) / len(blocked[1]) > 0.8
    assert sum(blocked[0]) / len(blocked[0]) < 0.2


# Neutral hosts and path segments that are not among the labelled ones.
BAD_PATHS = """
/casino-palace/poker-room/slotmania /grand-casinos/play /a/buy-viagra.html /pillsdirect/7 /pornstars/1
/watch/adultvideo/3 /bettingtips/today /go/spam-list /torrents-hub/9.html /replicabags /lotterytickets/win
"""
CLEAN_PATHS = """
/zz/1 /en/7817 /de/3.html /quux-7/ / /a/oldmuseum.html /citylibraries/7 /musiclessons/1 /watch/sciencefair/3
/weatherstation/today /go/bookclub /gardenershop/9.html /travelnotes /hospitaltrust/win
"""


def test_url_regression_judges_by_the_path_on_a_neutral_host(spark):
    labelled = catalogue.labelled_urls(spark)
    known = {s for r in url_filter.parts(labelled).select("path").distinct().collect() for s in r["path"].split("/")}
    kinds = [(path, bad) for bad, paths in enumerate((CLEAN_PATHS, BAD_PATHS)) for path in paths.split()]
    assert not known & {s for path in BAD_PATHS.split() for s in path.split("/") if s.strip("0123456789")}
    urls = [f"https://{h}{path}" for path, _ in kinds for h in ("garden.example", "hazelwick.org")]
    urls += ["https://garden.example/casino/poker/slots", "https://garden.example/en/1"]
    pages = spark.createDataFrame([*enumerate(urls)], "page_id long, url string")
    rows = sorted(url_filter.judge(pages, [], labelled, "page_id").collect())
    assert [r["page_id"] for r in rows] == [*range(len(urls))]
    verdicts = [r["verdict"] == "block" for r in rows]
    assert verdicts[-2:] == [True, False]
    bad, clean = ([v for v, (_, b) in zip(verdicts, (k for k in kinds for _ in range(2))) if b == kind] for kind in (1, 0))
    assert sum(bad) / len(bad) > 0.8
    assert sum(clean) / len(clean) < 0.2
