"""The registered queries of this subpackage, each on its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom import store
from tallyloom.llm import bpe, collocations, exact_dedup, language_mix, minhash, packing, pii, quality, records, simhash, topk, url_filter, variants
from tallyloom.llm.common import fold, ship, small_batches, table

BYTES = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")

# The rules that the query has to apply.
URL_RULES = """
allow org/
block example.org/es/
block example.org/en/1
allow com/fr/
block com/de/
"""

# Words of a general labelled URL table, from which the regression learns: 1 blocks. No host of
# the tables that the queries read is among the hosts made of them.
BLOCKED_WORDS = """
casino poker bets betting bookmaker wager jackpot slots roulette blackjack bingo lottery gamble
gambling adult porn xxx sex nude erotic fetish escort camgirls hookup pills viagra cialis steroids
pharma drugstore spam spammer linkfarm clickbait ads adserver banner tracker tracking popup
popunder malware spyware trojan virus keylogger botnet phishing fakelogin warez crack cracked
keygen torrent pirated freemoney getrich payday replica counterfeit scam fraud
"""
ALLOWED_WORDS = """
news shop store mail docs wiki forum library museum school college university city weather travel
recipes garden music books film theatre science history maths physics health hospital clinic bank
post train bus airport sport football tennis chess photo art design code data maps help support
status about contact press jobs events calendar archive research journal review magazine radio
television opensource notes family kitchen house street village river mountain forest island
harbour bridge church castle market farm baker butcher tailor builder painter writer teacher
doctor nurse lawyer engineer student children animals horses birds flowers trees summer winter
morning evening paper letter picture table window cloud water energy solar metal wood stone glass
cotton coffee cheese bread apple orange cycling walking running swimming sailing hiking camping
dance choir guitar piano violin orchestra poetry language grammar dictionary english german french
spanish council parliament election justice police army charity volunteer insurance finance
economy trade industry software hardware computer network security mobile account customer
"""
NAMES = ("{0}", "my{0}", "{0}-online", "{0}24", "{0}-{1}", "{1}{0}", "{0}{2}", "the-{2}-{0}")
SITES = ("https://{}.com/", "http://www.{}.org/about", "https://shop.{}.net/index.html", "https://{}.info/2021/05/12?p=7")

NEUTRAL_HOSTS = ("alderbrook.com", "www.fernhill.org", "rosefield.net", "millbrook.info")
PATHS = ("/{0}/", "/{0}/{1}/4", "/{1}/{0}.html", "/2020/{0}-{2}", "/{2}{0}/index.html", "/my{0}?p=2")


def _labelled_words() -> list[tuple[tuple[str, str, str], int]]:
    """Every word with two allowed ones to stand beside it, and its label."""
    allowed, blocked = ALLOWED_WORDS.split(), BLOCKED_WORDS.split()
    words = [(w, 0) for w in allowed] + [(w, 1) for w in blocked]
    beside = [[allowed[(step * i + step) % len(allowed)] for step in (7, 11)] for i in range(len(words))]
    return [((w, *others), label) for (w, label), others in zip(words, beside)]


def labelled_urls(spark: SparkSession) -> DataFrame:
    """Hosts named by the words, with the same further parts and paths for both labels, and
    paths that hold them, on the same neutral hosts for both labels.

    An allowed word beside a blocked one does not change its label.
    """
    words = _labelled_words()
    rows = [(s.format(n.format(*w)), label) for w, label in words for n in NAMES for s in SITES]
    rows += [(f"https://{h}{p.format(*w)}", label) for w, label in words for h in NEUTRAL_HOSTS for p in PATHS]
    return spark.createDataFrame(rows, "url string, label int")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    @wraps(fn)
    def shipped(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        small_batches(spark)
        return fn(spark, folder)

    QUERIES[fn.__name__] = shipped
    return shipped


@query
def op10_exact_dedup(spark, folder):
    rows = exact_dedup.dedup(table(spark, folder, "documents"))
    return rows.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


ORACLES["op10_exact_dedup"] = """
WITH rows AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents
), g AS (
  SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM rows GROUP BY body
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
       sha256(body) AS text_sha256
FROM rows JOIN g USING (body)
"""


@query
def op9_token_records(spark, folder):
    path = store.new_path(spark, "token-records")
    records.write(table(spark, folder, "documents"), path, WORDS, end=2)
    rows = records.read(spark, path).select(
        "shard", "record", "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
    starts = records.index(spark, path).select("shard", "record", "start")
    return rows.join(starts, ["shard", "record"]).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op2_best_fit_packing(spark, folder):
    found = packing.pieces(table(spark, folder, "documents"), WORDS, end=0)
    digests = found.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), *packing.RANKED)
    return packing.pack(digests).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query
def op1_simhash(spark, folder):
    rows = simhash.near_duplicates(table(spark, folder, "documents"))
    return rows.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op7_top_k(spark, folder):
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


ORACLES["op7_top_k"] = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(coalesce(list_sum([q.e[i] * c.e[i] for i in range(1, len(q.e) + 1)]), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query
def op6_url_filter(spark, folder):
    pages, labelled = table(spark, folder, "pages"), labelled_urls(spark)
    rows = url_filter.judge(pages, url_filter.rules(URL_RULES), labelled, "page_id")
    return rows.select("page_id", "host", "path", "rule", "verdict", "score")


@query
def op5_byte_bpe(spark, folder):
    rows = bpe.encode(table(spark, folder, "documents"), BYTES, public_tokenizers.PATTERN)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op8_pii(spark, folder):
    """``spans`` and ``base_sha256`` are written kind:start:end, joined by commas."""
    rows = pii.detect(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def written(spans):
        name = F.array(*map(F.lit, pii.KINDS))
        one = F.transform(spans, lambda s: F.concat_ws(":", name[s["kind"]], s["start"], s["end"]))
        return F.array_join(one, ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(pii.BASE_KINDS)]
    digest = F.sha2(written(base).cast("binary"), 256)
    return rows.select("doc_id", *counts, digest.alias("base_sha256"), written("spans").alias("spans"))


@query
def op3_quality(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    marks = labels.select("doc_id", F.col("quality").alias("label"))
    weights = quality.fit(docs, marks, fold(F.col("doc_id"), 3) != 1)
    return quality.score(docs, weights).select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op4_language(spark, folder):
    docs = table(spark, folder, "documents")
    languages = language_mix.fit(docs, fold(F.col("doc_id"), 4) != 2)
    return language_mix.detect(docs, languages).select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(True)).alias("held_out"),
        "lang_pred",
        "score",
        "shares",
    )


@query
def op13_minhash(spark, folder):
    return minhash.near_duplicates(table(spark, folder, "documents"))


# The component of a document is the smallest id that it reaches over links, as links are mutual.
ORACLES["op13_minhash"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') if x <> ''] AS words
  FROM documents
), s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(words) = 1 THEN words ELSE list_distinct(
    [words[i] || ' ' || words[i + 1] for i in range(1, len(words))]) END AS shingles
  FROM w
), r AS MATERIALIZED (
  SELECT min(doc_id) AS rep, list_sort(shingles) AS shingles FROM s WHERE len(shingles) > 0 GROUP BY 2
), e AS MATERIALIZED (
  SELECT rep, len(shingles) AS n, unnest(shingles) AS shingle FROM r
), both_ways AS MATERIALIZED (
  SELECT a.rep AS u, b.rep AS v
  FROM e a JOIN e b ON a.shingle = b.shingle AND a.rep <> b.rep AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.rep, b.rep
  HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
  SELECT u AS node, v AS seen FROM both_ways
  UNION SELECT reach.node, both_ways.v FROM reach JOIN both_ways ON reach.seen = both_ways.u
), c AS (
  SELECT r.rep, least(r.rep, min(reach.seen)) AS component_id, r.shingles
  FROM r LEFT JOIN reach ON reach.node = r.rep GROUP BY r.rep, r.shingles
)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles,
       CASE WHEN len(s.shingles) = 0 THEN s.doc_id ELSE c.component_id END AS component_id,
       s.doc_id = CASE WHEN len(s.shingles) = 0 THEN s.doc_id ELSE c.component_id END AS kept
FROM s LEFT JOIN c ON list_sort(s.shingles) = c.shingles
"""


@query
def op11_collocations(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))


ORACLES["op11_collocations"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS MATERIALIZED (
  SELECT lang, [x for x in string_split_regex(piece, '[\x20\x09]+') if x <> ''] AS words FROM p
), f AS MATERIALIZED (
  SELECT lang, size, phrase, count(*) AS f FROM (
    SELECT lang, 1 AS size, unnest(words) AS phrase FROM w
    UNION ALL
    SELECT lang, 2, unnest([words[i] || ' ' || words[i + 1] for i in range(1, len(words))]) FROM w
    UNION ALL
    SELECT lang, 3, unnest([words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] for i in range(1, len(words) - 1)]) FROM w
  ) GROUP BY ALL
), n AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang
), c AS (
  SELECT lang, phrase, f AS a, size, string_split(phrase, ' ') AS words, unnest(range(1, size)) AS k
  FROM f WHERE size > 1 AND f >= 10
), s AS (
  SELECT c.lang, c.phrase, c.size, c.words, c.a, c.k, l.f AS l, r.f AS r,
         CAST(1000000 * CAST(c.a AS HUGEINT) * c.a // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:c.k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[c.k + 1:c.size], ' ')
), best AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_parts AS (
  SELECT lang, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) AS phrase, a
  FROM best WHERE size = 3
), longest AS (
  SELECT lang, phrase, max(a) AS longest FROM inner_parts GROUP BY lang, phrase
), kept AS (
  SELECT best.* FROM best LEFT JOIN longest USING (lang, phrase)
  WHERE longest IS NULL OR 100 * longest < 50 * a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


@query
def op12_spelling_variants(spark, folder):
    return variants.variants(table(spark, folder, "documents"))
