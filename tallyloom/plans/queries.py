"""Registered queries: each reads the whole tables it names and returns one DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom import store
from tallyloom.functions import casts, keys, text, vectors
from tallyloom.operators import (
    blend,
    classify,
    content,
    factorise,
    features,
    language,
    metrics,
    missing,
    neighbours,
    pairs,
    profile,
    sampling,
    sentiment,
    similarity,
    terms,
    topics,
)
from tallyloom.plans import inputs, postings, ratings, tweets
from tallyloom.sources import readers, writers

LARGE = 3_000_000_000

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Results of the long searches, by application, folder and name: queries that need the same search
# share it. Each is kept with the stamp of the tables it was made from, and made anew when they change.
_SEARCHED: dict = {}

RATED = ["lineitem", "orders", "supplier", "nation", "region"]
POSTED = ["documents", "labels"]


def _once(spark, folder, name, tables, make):
    key = (spark.sparkContext.applicationId, folder, name)
    stamp = store.stamp(spark, [f"{folder.rstrip('/')}/{t}.parquet" for t in tables])
    if key not in _SEARCHED or _SEARCHED[key][0] != stamp:
        _SEARCHED[key] = stamp, make()
    return _SEARCHED[key][1]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# --- sources and sinks ---------------------------------------------------------------


@query
def csv_postings(spark, folder):
    """Postings written as CSV with quoted newlines, read back, label cast."""
    path = store.new_path(spark, "postings-csv")
    writers.write_csv(inputs.postings(spark, folder), path)
    return readers.read_postings(spark, path)


@query
def csv_tweets(spark, folder):
    path = store.new_path(spark, "tweets-csv")
    writers.write_csv(inputs.tweets(spark, folder), path)
    back = readers.read_tweets(spark, path, ["doc_id", "tweet", "lang"])
    return back.withColumn("doc_id", F.col("doc_id").try_cast("bigint"))


@query
def csv_ratings(spark, folder):
    """Tab-separated ratings with a timestamp column that is dropped."""
    path = store.new_path(spark, "ratings-csv")
    writers.write_csv(_half_stars(spark, folder), path, sep="\t")
    return readers.read_ratings(spark, path, sep="\t")


def _half_stars(spark, folder, shift=0):
    return inputs.ratings(spark, folder).select(
        (F.col("user_id") + shift).alias("userId"),
        (F.col("item_id") + shift).alias("movieId"),
        (F.col("rating") - 0.5).alias("rating"),
        F.lit("0").alias("timestamp"),
    )


def _dirty_ratings(spark, folder):
    """A file of ratings some of whose rows, by key, are not what they should be."""
    key = F.col("user_id") * 31 + F.col("item_id")
    good = F.concat_ws(",", "user_id", "item_id", "rating", F.lit("0"))
    line = (
        F.when(key % 11 == 0, F.concat_ws(",", "user_id", "item_id"))
        .when(key % 13 == 0, F.concat(good, F.lit(",more")))
        .when(key % 17 == 0, F.concat(F.lit("u"), good))
        .when(key % 19 == 0, F.concat_ws(",", "user_id", F.lit(""), "rating", F.lit("0")))
        .when(key % 23 == 0, F.concat_ws(",", "user_id", "item_id", F.lit("4,5")))
        .when(key % 29 == 0, F.concat_ws(",", "user_id", "item_id", F.lit("good"), F.lit("0")))
        .otherwise(good)
    )
    path = store.new_path(spark, "dirty-ratings")
    inputs.ratings(spark, folder).select(line.alias("value")).write.text(path)
    return path


@query
def dirty_ratings(spark, folder):
    """The rows of such a file that are ratings: the comma of a "4,5" moves the other half star."""
    return readers.read_ratings(spark, _dirty_ratings(spark, folder), header=False)


@query
def rejected_ratings(spark, folder):
    """How many rows were left out, by reason, and how many different lines they are."""
    rows = readers.rejected_ratings(spark, _dirty_ratings(spark, folder), header=False)
    return rows.groupBy("reason").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("line").alias("n_lines")
    )


@query
def large_id_baseline(spark, folder):
    """Ratings with ids beyond INT: written, read, split and predicted."""
    path = store.new_path(spark, "large-ids-csv")
    writers.write_csv(_half_stars(spark, folder, LARGE), path)
    return ratings.baseline_predictions(ratings.split_ratings(readers.read_ratings(spark, path)))


@query
def csv_item_names(spark, folder):
    """Rating counts per item with the title from a pipe-separated Latin-1 file."""
    path = store.new_path(spark, "items-csv")
    rows = inputs.items(spark, folder).withColumnRenamed("item_id", "movieId")
    writers.write_csv(rows, path, sep="|", encoding="ISO-8859-1")
    names = readers.read_items(spark, path, sep="|", encoding="ISO-8859-1")
    totals = similarity.rating_totals(inputs.ratings(spark, folder))
    return names.join(totals, "item_id").select("item_id", "title", "n_ratings")


@query
def handed_over_predictions(spark, folder):
    """Predictions written by one job and read, typed, by the next."""
    path = store.new_path(spark, "handed-over")
    rows = ratings.baseline_predictions(ratings.split_ratings(inputs.ratings(spark, folder)))
    writers.write_table(rows.withColumn("rating", F.col("rating").cast("double")), path, True)
    return readers.read_predictions(spark, path)


@query
def headerless_predictions(spark, folder):
    path = store.new_path(spark, "headerless")
    rows = ratings.baseline_predictions(ratings.split_ratings(inputs.ratings(spark, folder)))
    writers.write_csv(rows, path, overwrite=True, header=False)
    return readers.read_predictions_csv(spark, path)


# --- profiling, classes, missing values ----------------------------------------------


def _valid(spark, folder):
    rows = inputs.postings(spark, folder)
    rows = rows.withColumn("fraudulent", casts.int_or_null(F.col("fraudulent")))
    return profile.valid_classes(rows, "fraudulent")


@query
def null_profile(spark, folder):
    return profile.null_profile(inputs.postings(spark, folder))


@query
def row_count(spark, folder):
    return profile.row_count(inputs.postings(spark, folder))


@query
def valid_class_filter(spark, folder):
    return _valid(spark, folder).select("job_id", "fraudulent")


@query
def drop_sparse_columns(spark, folder):
    return profile.drop_sparse_columns(_valid(spark, folder))


@query
def class_balance(spark, folder):
    return profile.class_balance(_valid(spark, folder), "fraudulent")


def _flags(spark, folder):
    return missing.clean_flags(inputs.postings(spark, folder), classify.FLAGS).select(
        "job_id", *classify.FLAGS
    )


@query
def clean_flags(spark, folder):
    return _flags(spark, folder)


@query
def impute_mean(spark, folder):
    filled = missing.impute_mean(_flags(spark, folder), classify.FLAGS)
    return filled.withColumns({c: F.round(c, 6) for c in classify.FLAGS})


@query
def impute_whole_mean(spark, folder):
    return missing.impute_mean(_flags(spark, folder), classify.FLAGS, whole=True)


# --- samples and splits --------------------------------------------------------------


@query
def hash_split(spark, folder):
    part = sampling.split_number(F.col("job_id"), [70, 30])
    return inputs.postings(spark, folder).select("job_id", part.alias("part"))


@query
def stratified_hash_sample(spark, folder):
    rows = _valid(spark, folder).select("job_id", "fraudulent")
    return sampling.stratified_hash_sample(
        rows, "fraudulent", {0: 0.055, 1: 1}, F.col("job_id")
    )


@query
def native_sample_by(spark, folder):
    rows = _valid(spark, folder).select("job_id", "fraudulent")
    return sampling.native_sample_by(rows, "fraudulent", {0: 0.055, 1: 1}, seed=0)


@query
def native_random_split(spark, folder):
    """How often each row occurs over both parts, and whether the parts have about the shares
    asked for: the first holds seven tenths of the rows, give or take five standard deviations."""
    rows = inputs.postings(spark, folder).select("job_id")
    a, b = sampling.native_random_split(rows, [0.7, 0.3], seed=0)
    parts = a.withColumn("part", F.lit(0)).unionByName(b.withColumn("part", F.lit(1)))
    total, first = F.count(F.lit(1)), F.count_if(F.col("part") == 0)
    close = parts.agg((F.abs(first - 0.7 * total) <= 5 * F.sqrt(0.21 * total)).alias("shares_hold"))
    copies = parts.groupBy("job_id").agg(F.count(F.lit(1)).alias("copies"))
    return copies.crossJoin(close)  # one row


# --- text ----------------------------------------------------------------------------


@query
def clean_text(spark, folder):
    return inputs.postings(spark, folder).select(
        "job_id",
        text.clean_prose(F.col("title")).alias("title"),
        text.squash(text.clean_prose(F.col("title"))).alias("title_squashed"),
        text.clean_prose(F.col("description")).alias("description"),
    )


@query
def clean_tweet(spark, folder):
    return inputs.tweets(spark, folder).select(
        "doc_id", text.clean_tweet(F.col("tweet")).alias("tweet")
    )


@query
def clean_items(spark, folder):
    return inputs.items(spark, folder).select(
        "item_id",
        text.clean_item_title(F.col("title")).alias("title"),
        text.clean_genres(F.col("genres")).alias("genres"),
    )


@query
def strip_markup(spark, folder):
    return inputs.texts(spark, folder, "pages", "page_id").select(
        "page_id", text.strip_markup(F.col("html")).alias("body")
    )


@query
def stop_word_filter(spark, folder):
    words = text.drop_words(F.split(text.strip_markup(F.col("html")), " "))
    return inputs.texts(spark, folder, "pages", "page_id").select(
        "page_id", F.size(words).alias("n_words"), F.concat_ws(" ", words).alias("words")
    )


def _prose():
    return text.clean_prose(F.col("text"))


@query
def tokens(spark, folder):
    kept = text.tokens(_prose(), keep_empty=True)
    content_words = text.content_tokens(_prose())
    return inputs.texts(spark, folder, "documents", "doc_id").select(
        "doc_id",
        F.size(kept).alias("n_tokens"),
        F.size(content_words).alias("n_words"),
        F.concat_ws("|", content_words).alias("words"),
    )


def _term_rows(spark, folder):
    docs = inputs.texts(spark, folder, "documents", "doc_id")
    return terms.explode_terms(docs, "doc_id", F.split(_prose(), r"\s"))


@query
def term_counts(spark, folder):
    return terms.term_counts(terms.term_frequencies(_term_rows(spark, folder), "doc_id"))


@query
def vocabulary_size(spark, folder):
    return terms.vocabulary_size(_term_rows(spark, folder))


@query
def tfidf_long(spark, folder):
    docs = inputs.table(spark, folder, "documents")
    tf = terms.term_frequencies(_term_rows(spark, folder), "doc_id")
    return terms.tfidf_long(store.materialise(tf, "term-frequencies"), docs).select(
        "doc_id", "term", "tf", "df", F.round("tfidf", 6).alias("tfidf")
    )


def _word_frequencies(rows):
    words = rows.select("doc_id", F.explode("words").alias("term")).where("term <> ''")
    return terms.term_frequencies(words, "doc_id")


def _worded(spark, folder):
    docs = inputs.texts(spark, folder, "documents", "doc_id")
    words = docs.select("doc_id", text.content_tokens(_prose()).alias("words"))
    return store.materialise(words, "document-words")


@query
def count_vectors(spark, folder):
    """Count vectors and their IDF weights, taken apart into long form."""
    rows = _worded(spark, folder)
    tf = store.materialise(_word_frequencies(rows), "word-frequencies")
    counted = features.count_vectors(tf, rows, "doc_id")
    entries = vectors.vector_rows(counted.vectors, "doc_id", "counts")
    # Weighted by number: the words themselves, which are longer, meet the rows last.
    weighted = terms.tfidf_long(entries.select("doc_id", F.col("index").alias("term"), F.col("value").alias("tf")), rows)
    weighted = weighted.withColumnRenamed("term", "term_id").join(counted.ids, "term_id")
    return weighted.select("doc_id", "term", F.round("tfidf", 6).alias("tfidf"))


@query
def hashed_tfidf_vectors(spark, folder):
    rows = _worded(spark, folder)
    stages = features.hashed_tfidf("words", "tfidf", classify.HASH_WIDTH)
    model = topics.fit(Pipeline(stages=stages), rows)
    entries = vectors.vector_rows(model.transform(rows), "doc_id", "tfidf")
    return entries.select("doc_id", "index", F.round("value", 6).alias("tfidf"))


@query
def assembled_features(spark, folder):
    """Stored feature entries per prepared posting."""
    table = postings.prepared(inputs.postings(spark, folder))
    ready = classify.build_features(table, classify.HASH_WIDTH)
    rows = ready.train.unionByName(ready.test)
    return rows.select(
        "job_id", "label", F.size(vectors.vector_entries(F.col("features"))).alias("n_entries")
    )


# --- language and sentiment ----------------------------------------------------------


@query
def language_id(spark, folder):
    docs = inputs.texts(spark, folder, "documents", "doc_id")
    return tweets.identify(docs, "doc_id", "text", "lang")


@query
def unlabelled_language_id(spark, folder):
    """Every third text has no label: profiles come from the others, all texts are scored."""
    docs = inputs.texts(spark, folder, "documents", "doc_id")
    some = docs.withColumn("lang", F.when(F.col("doc_id") % 3 > 0, F.col("lang")))
    return tweets.identify(some, "doc_id", "text", "lang")


@query
def english_filter(spark, folder):
    found = tweets.english(inputs.tweets(spark, folder), "doc_id", "tweet", "lang")
    return found.select("doc_id", "tweet", "lang")


def _sentiment(spark, folder):
    known = store.materialise(inputs.lexicon(spark, folder), "lexicon")
    rows = language.keep_language(inputs.tweets(spark, folder))
    return sentiment.sentiment_score(rows, known, "doc_id", "tweet")


@query
def sentiment_score(spark, folder):
    return _sentiment(spark, folder)


@query
def sentiment_balance(spark, folder):
    return profile.class_balance(_sentiment(spark, folder), "sentiment")


# --- ratings -------------------------------------------------------------------------


@query
def ratings_with_items(spark, folder):
    return content.rate_items(inputs.ratings(spark, folder), inputs.items(spark, folder))


@query
def item_rating_totals(spark, folder):
    return similarity.rating_totals(inputs.ratings(spark, folder))


@query
def item_means(spark, folder):
    means = similarity.item_means(inputs.ratings(spark, folder))
    return means.select("item_id", F.round("item_mean", 6).alias("item_mean"))


def _rating_table(spark, folder):
    return store.materialise(inputs.ratings(spark, folder), "ratings")


@query
def user_means(spark, folder):
    """Mean rating and mean residual (rating minus item mean) per user."""
    rows = _rating_table(spark, folder)
    means = store.materialise(similarity.item_means(rows), "item-means")
    return similarity.user_residual_means(rows, means).select(
        "user_id",
        F.round("user_mean", 6).alias("user_mean"),
        F.round("residual_mean", 6).alias("residual_mean"),
    )


@query
def global_mean(spark, folder):
    means = similarity.item_means(inputs.ratings(spark, folder))
    return neighbours.global_item_mean(means).select(F.round("global_mean", 6).alias("global_mean"))


@query
def item_similarity(spark, folder):
    rows = _rating_table(spark, folder)
    means = store.materialise(similarity.item_means(rows), "item-means")
    return similarity.item_similarities(rows, means, pairs.user_load(rows))


@query
def supported_similarity(spark, folder):
    """Pairs rated together by 150 users or more."""
    rows = _rating_table(spark, folder)
    means = store.materialise(similarity.item_means(rows), "item-means")
    return similarity.item_similarities(rows, means, pairs.user_load(rows), 150)


def _split(spark, folder):
    return ratings.split_ratings(inputs.ratings(spark, folder))


@query
def baseline_prediction(spark, folder):
    return ratings.baseline_predictions(_split(spark, folder))


@query
def nearest_neighbours(spark, folder):
    return ratings.nearest(_split(spark, folder)).select(
        "user_id", "item_id", "rank", "neighbour", "similarity"
    )


@query
def cf_predictions(spark, folder):
    return ratings.neighbour_predictions(_split(spark, folder))


@query
def cf_metrics(spark, folder):
    return metrics.regression_metrics(ratings.neighbour_predictions(_split(spark, folder)))


@query
def blend_two(spark, folder):
    """Baseline and item mean, blended with the pair weights."""
    data = _split(spark, folder)
    return blend.blend(
        ratings.baseline_predictions(data), ratings.item_mean_predictions(data)
    )


@query
def blend_three(spark, folder):
    """The same with the neighbour predictions as third table."""
    data = _split(spark, folder)
    return blend.blend_three(
        ratings.baseline_predictions(data),
        ratings.item_mean_predictions(data),
        ratings.neighbour_predictions(data),
    )


# --- evaluation ----------------------------------------------------------------------


@query
def regression_metrics(spark, folder):
    return metrics.regression_metrics(ratings.baseline_predictions(_split(spark, folder)))


@query
def confusion_metrics(spark, folder):
    """The logo flag read as a prediction of the label."""
    guess = F.coalesce(casts.flag_or_null(F.col("has_company_logo")), F.lit(0))
    rows = _valid(spark, folder).select(F.col("fraudulent").alias("label"), guess.alias("prediction"))
    return metrics.confusion_metrics(rows)


@query
def auc_rank(spark, folder):
    """Text length read as a score for the label."""
    rows = _valid(spark, folder).select(
        F.col("fraudulent").alias("label"), F.length("description").alias("score")
    )
    return metrics.auc(rows)


@query
def auc_missing_scores(spark, folder):
    """The same with some scores missing: those rows take no part."""
    rows = _valid(spark, folder).select(
        F.col("fraudulent").alias("label"),
        F.when(F.col("job_id") % 5 > 0, F.length("description")).alias("score"),
    )
    return metrics.auc(rows)


# --- classifiers ---------------------------------------------------------------------


def _ready(spark, folder, width):
    """The feature tables of one width; the learners that use it share them."""

    def make():
        return classify.build_features(postings.prepared(inputs.postings(spark, folder)), width)

    return _once(spark, folder, f"features-{width}", POSTED, make)


def _trained(spark, folder, name):
    def make():
        return classify.train_and_score(name, _ready(spark, folder, classify.hash_width(name)))

    return _once(spark, folder, f"classify-{name}", POSTED, make)


def _classified(spark, folder, name):
    return _trained(spark, folder, name).scored


@query
def classify_mlp(spark, folder):
    return _classified(spark, folder, "mlp")


@query
def classify_logistic(spark, folder):
    return _classified(spark, folder, "logistic")


@query
def classify_svc(spark, folder):
    return _classified(spark, folder, "svc")


@query
def classify_forest(spark, folder):
    return _classified(spark, folder, "forest")


@query
def cross_validation(spark, folder):
    """Mean fold metric of each point of a small logistic grid."""
    data = _ready(spark, folder, classify.HASH_WIDTH)
    grid = {"maxIter": [10], "regParam": [0.02, 0.2]}
    return classify.search("logistic", data, **grid).search(spark)


@query
def model_report(spark, folder):
    """Best parameters and test metrics of all four learners."""
    return classify.report([_trained(spark, folder, n) for n in ("mlp", "logistic", "svc", "forest")])


def _rows_of(spark, folder, name):
    """Which rows a learner scored, with their labels, and whether it gave a class."""
    rows = _trained(spark, folder, name).scored
    return rows.select("job_id", "label", F.col("prediction").isin(0.0, 1.0).alias("classed"))


@query
def logistic_rows(spark, folder):
    return _rows_of(spark, folder, "logistic")


@query
def svc_rows(spark, folder):
    return _rows_of(spark, folder, "svc")


@query
def forest_rows(spark, folder):
    return _rows_of(spark, folder, "forest")


@query
def mlp_rows(spark, folder):
    return _rows_of(spark, folder, "mlp")


# --- topics --------------------------------------------------------------------------


def _english_words(spark, folder):
    rows = language.keep_language(inputs.tweets(spark, folder))
    return tweets.tokenised(rows, "doc_id", "tweet")


def _counts_pipeline(docs):
    """Over the whole vocabulary."""
    return topics.counts_pipeline(features.vocabulary_width(docs, "words"))


def _count_topics(spark, folder):
    """The topics as a table, and the word frequencies they were learned from."""

    def make():
        docs = _english_words(spark, folder)
        tf = store.materialise(_word_frequencies(docs), "word-frequencies")
        return topics.fit_table(features.count_vectors(tf, docs, "doc_id")), tf

    return _once(spark, folder, "count-topics", ["documents"], make)


def _topic_pipeline(spark, folder):
    """The same as an MLlib pipeline, saved before its fit and after it, and loaded again."""

    def make():
        docs = _english_words(spark, folder)
        path = store.new_path(spark, "topic-model")
        writers.save_estimator(_counts_pipeline(docs), f"{path}/estimator")
        fitted = topics.fit(writers.load_estimator(f"{path}/estimator"), docs)
        writers.save_model(fitted, f"{path}/model")
        return writers.load_model(f"{path}/model")

    return _once(spark, folder, "topic-pipeline", ["documents"], make)


@query
def topic_terms_covered(spark, folder):
    """The terms of the topics matrix: each has a weight of 0 or more in every topic."""
    rows = topics.table_words(_count_topics(spark, folder)[0])
    return rows.groupBy("term").agg(
        F.countDistinct("topic").alias("n_topics"), (F.min("weight") >= 0).alias("weighted")
    )


@query
def doc_topic_sums(spark, folder):
    """Number and sum of the topic shares of each English document; both are 0 without words."""
    table, tf = _count_topics(spark, folder)
    shares = topics.fold_in(table, tf, "doc_id").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("weight"), 6).alias("s")
    )
    docs = language.keep_language(inputs.tweets(spark, folder)).select("doc_id")
    return docs.join(shares, "doc_id", "left").select(
        "doc_id",
        F.coalesce("n", F.lit(0).cast("long")).alias("n_topics"),
        F.coalesce("s", F.lit(0.0)).alias("share_sum"),
    )


@query
def topic_report(spark, folder):
    """Parameters of the topic model's stages."""
    return topics.report(_topic_pipeline(spark, folder))


@query
def topics_counts(spark, folder):
    return topics.table_words(_count_topics(spark, folder)[0], 100)


@query
def topics_tfidf(spark, folder):
    model = topics.fit(topics.hashed_pipeline(), _english_words(spark, folder))
    return topics.topic_terms(model, 50)


@query
def topic_word_lists(spark, folder):
    return topics.word_lists(topics.table_words(_count_topics(spark, folder)[0], 100))


@query
def topic_matrix(spark, folder):
    """Every term's weight in every topic."""
    return topics.table_words(_count_topics(spark, folder)[0])


@query
def doc_topics(spark, folder):
    """Topic shares per document from a model that was saved and loaded again."""
    docs = _english_words(spark, folder)
    return topics.doc_topics(_topic_pipeline(spark, folder), docs, "doc_id")


def _labelled(spark, folder):
    return tweets.labelled(
        inputs.tweets(spark, folder), inputs.lexicon(spark, folder), "doc_id", "tweet"
    )


@query
def sentiment_lr_tfidf(spark, folder):
    return tweets.train_sentiment(_labelled(spark, folder), "doc_id").scored


@query
def sentiment_lr_topics(spark, folder):
    return tweets.train_sentiment(_labelled(spark, folder), "doc_id", True).scored


@query
def sentiment_lr_auc(spark, folder):
    return tweets.train_sentiment(_labelled(spark, folder), "doc_id").area_under_roc


# --- recommendation models -----------------------------------------------------------


def _factors(spark, folder, data):
    """The full search: 18 points, 5 folds."""
    return _once(spark, folder, "factors", RATED, lambda: factorise.fit(data.train))


def _regression(spark, folder, data):
    """The full search: 6 points, 5 folds."""
    items = inputs.items(spark, folder)
    return _once(spark, folder, "regression", RATED, lambda: content.fit(data.train, items))


def _regressed(spark, folder, data):
    return content.predict(_regression(spark, folder, data), data.test)


@query
def als_predictions(spark, folder):
    data = _split(spark, folder)
    return factorise.predict(_factors(spark, folder, data), data.test)


def _scored_rows(rows):
    good = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    return rows.select("user_id", "item_id", F.col("rating").cast("double").alias("rating"), good.alias("scored"))


@query
def als_rows(spark, folder):
    """Every test row has a prediction of the factorisation, or of what is known without it."""
    return _scored_rows(als_predictions(spark, folder))


@query
def regression_rows(spark, folder):
    return _scored_rows(content_regression(spark, folder))


@query
def hybrid_rows(spark, folder):
    return _scored_rows(hybrid_predictions(spark, folder))


@query
def cold_start_rows(spark, folder):
    """Test rows by whether the factorisation knows their user and their item."""
    data = _split(spark, folder)
    factors = _factors(spark, folder, data)
    users = factors.users.select(F.col("id").alias("user_id"), F.lit(True).alias("u"))
    items = factors.items.select(F.col("id").alias("item_id"), F.lit(True).alias("i"))
    rows = data.test.join(users, "user_id", "left").join(items, "item_id", "left")
    known = [F.coalesce(c, F.lit(False)).alias(name) for c, name in (("u", "user_known"), ("i", "item_known"))]
    return rows.select(*known).groupBy("user_known", "item_known").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def als_top_n_sizes(spark, folder):
    """How many items each user with test rows is given, over how many ranks."""
    return als_top_n(spark, folder).groupBy("user_id").agg(
        F.countDistinct("item_id").alias("n_items"), F.max("rank").alias("last_rank")
    )


@query
def recommender_report(spark, folder):
    """Grid points and mean fold errors of the factorisation and of the regression."""
    data = _split(spark, folder)
    tables = {
        "als": _factors(spark, folder, data).search(spark),
        "regression": _regression(spark, folder, data).tuned.search(spark),
    }
    out = None
    for name, rows in tables.items():
        rows = rows.select(F.lit(name).alias("model"), "point", "params", "metric")
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def als_top_n(spark, folder):
    """Ten best items for every user with test rows."""
    data = _split(spark, folder)
    return factorise.top_items(_factors(spark, folder, data), data.test)


@query
def content_regression(spark, folder):
    data = _split(spark, folder)
    return _regressed(spark, folder, data)


def _hybrid(spark, folder):
    data = _split(spark, folder)
    factors, regressed = _factors(spark, folder, data), _regressed(spark, folder, data)
    return ratings.blended(data, factorise.predict(factors, data.test), regressed)


@query
def hybrid_predictions(spark, folder):
    """Blend of factorisation, regression and neighbours."""
    return _hybrid(spark, folder).three


@query
def hybrid_metrics(spark, folder):
    return _hybrid(spark, folder).scores()
