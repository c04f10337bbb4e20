import pytest
from pyspark.ml.feature import IDF, CountVectorizer, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from tallyloom.functions import text, vectors
from tallyloom.operators import features, language, sentiment, terms
from tallyloom.plans import inputs, tweets

EDGES = ["", None, "the and of", "  lead", "in  side", "trail  ", "   ", "Don't STOP\nnow", "é ü ok"]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(list(enumerate(EDGES)), "id int, text string")


def test_stop_words_are_sparks(spark):
    assert text.STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_tokens_with_empties_equal_tokenizer(spark, edges):
    known = edges.filter("text is not null")
    ours = known.select("id", text.tokens(F.col("text"), keep_empty=True).alias("w"))
    theirs = Tokenizer(inputCol="text", outputCol="w").transform(known).select("id", "w")
    assert sorted(ours.collect()) == sorted(theirs.collect())


def test_content_tokens_equal_stop_words_remover(spark, edges):
    known = edges.filter("text is not null")
    ours = known.select("id", text.content_tokens(F.col("text"), keep_empty=True).alias("w"))
    raw = Tokenizer(inputCol="text", outputCol="t").transform(known)
    theirs = StopWordsRemover(inputCol="t", outputCol="w").transform(raw).select("id", "w")
    assert sorted(ours.collect()) == sorted(theirs.collect())


def test_null_and_blank_text_have_no_tokens(edges):
    rows = edges.select("id", text.content_tokens(F.col("text")).alias("w")).collect()
    words = {r.id: r.w for r in rows}
    assert words[0] == words[1] == words[2] == words[6] == []
    assert words[3] == ["lead"] and words[4] == ["side"] and words[5] == ["trail"]


def test_prose_pattern_is_a_list_of_ranges_and_takes_out_the_same(spark):
    """Every code point, alone and in runs between letters and blanks."""
    points = [chr(i) for i in range(1, 0x110000) if not 0xD800 <= i <= 0xDFFF]
    rows = ["".join(points[a : a + 997]) for a in range(0, len(points), 997)]
    rows += ["".join(f"a{c} {c}{c}Z" for c in points[a : a + 97]) for a in range(0, 4000, 97)] + ["", "\x00x"]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    old, new = (F.regexp_replace("t", p, "") for p in (r"[^a-zA-Z\s]", text.NOT_PROSE))
    assert df.where(~old.eqNullSafe(new)).count() == 0
    assert "^" not in text.NOT_PROSE


def test_cleaners(spark):
    row = (
        spark.createDataFrame(
            [("Big  JOB!\n\nNow, 2day", "#Hi + you_2", "Heat (1995)", "Sci-Fi|Drama")],
            "a string, b string, c string, d string",
        )
        .select(
            text.clean_prose(F.col("a")),
            text.squash(text.clean_prose(F.col("a"))),
            text.clean_tweet(F.col("b")),
            text.clean_item_title(F.col("c")),
            text.clean_genres(F.col("d")),
        )
        .first()
    )
    assert tuple(row) == ("big job now day", "bigjobnowday", "hi + you", "heat 1995", "sci-fi drama")


def test_markup_goes_before_punctuation(spark):
    df = spark.createDataFrame([("<b\nclass='x'>Bold</b>, a\\b & C",)], "t string")
    row = df.select(text.strip_markup(F.col("t")).alias("t")).first()
    assert row.t == "bold  ab   c"
    words = df.select(text.drop_words(F.split(text.strip_markup(F.col("t")), " ")).alias("w"))
    assert words.first().w == ["bold", "ab", "c"]


def test_long_tfidf_equals_mllib(spark, small):
    docs = inputs.table(spark, small, "documents").limit(40).cache()
    words = docs.select("doc_id", text.content_tokens(text.clean_prose(F.col("text"))).alias("w"))
    tf = CountVectorizer(inputCol="w", outputCol="tf").fit(words)
    counted = tf.transform(words)
    weighted = IDF(inputCol="tf", outputCol="v").fit(counted).transform(counted)
    vocabulary = features.vocabulary_table(spark, tf.vocabulary)
    theirs = vectors.vector_rows(weighted, "doc_id", "v").join(
        vocabulary, F.col("index") == F.col("term_id")
    )
    rows = words.select("doc_id", F.explode("w").alias("term"))
    ours = terms.tfidf_long(terms.term_frequencies(rows, "doc_id"), docs)

    def table(df, value):
        return {(r.doc_id, r.term): round(r[value], 9) for r in df.collect()}

    assert table(ours, "tfidf") == table(theirs, "value")


def test_vector_entries_of_dense_and_sparse(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame(
        [(1, Vectors.sparse(4, {1: 2.0})), (2, Vectors.dense([0.0, 3.0]))], ["id", "v"]
    )
    rows = {tuple(r) for r in vectors.vector_rows(df, "id", "v").collect()}
    assert rows == {(1, 1, 2.0), (2, 0, 0.0), (2, 1, 3.0)}


def test_language_by_brute_force(spark):
    import math
    import re
    from collections import Counter

    docs = [
        (1, "the cat and the dog", "en"),
        (2, "der hund und die katze", "de"),
        (3, "le chat et le chien à côté", "fr"),
        (4, "the hund", "en"),
        (5, "123 !!", "en"),
        (6, None, "de"),
        (7, "the chat und", None),
    ]
    df = spark.createDataFrame(docs, "id int, text string, lang string")
    profile = language.fit_profile(df, "text", "lang")
    got = {r.id: (r.lang, r.score) for r in language.score_languages(df, profile, "id", "text").collect()}

    def words(t):
        return [w for w in re.split("[^a-zà-ÿ]+", (t or "").lower()) if w]

    counts = {l: Counter(w for _, t, g in docs if g == l for w in words(t)) for l in ("de", "en", "fr")}
    for key, t, _ in docs:
        if not words(t):
            assert got[key] == ("none", 0.0)
            continue
        scores = {
            l: sum(math.log((c[w] + 1) / (c.total() + 1000)) for w in words(t))
            for l, c in counts.items()
        }
        best = max(sorted(scores), key=scores.get)
        assert got[key][0] == best and abs(got[key][1] - scores[best]) < 1e-3


def test_sentiment_by_hand(spark):
    docs = spark.createDataFrame(
        [(1, "Good good bad"), (2, "bad"), (3, "good bad"), (4, ""), (5, None), (6, "unknown")],
        "id int, text string",
    )
    words = spark.createDataFrame([("good", 1.0), ("bad", -1.0)], "term string, polarity double")
    rows = sentiment.sentiment_score(docs, words, "id", "text").collect()
    assert {r.id: (r.polarity, r.sentiment) for r in rows} == {
        1: (0.333333, 1),
        2: (-1.0, 0),
        3: (0.0, 0),
        4: (0.0, 0),
        5: (0.0, 0),
        6: (0.0, 0),
    }


def test_english_filter_uses_the_identified_language(spark, small):
    docs = inputs.tweets(spark, small)
    found = tweets.english(docs, "doc_id", "tweet", "lang")
    assert found.columns == ["doc_id", "tweet", "lang"]
    assert {r.lang for r in found.select("lang").distinct().collect()} == {"en"}
