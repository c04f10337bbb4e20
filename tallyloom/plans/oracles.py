"""DuckDB SQL that gives each registered query's rows by an independent route."""

from __future__ import annotations

from tallyloom.functions.text import STOP_WORDS

POSTINGS = """postings AS (
  SELECT d.doc_id AS job_id, split_part(d.text, '.', 1) AS title, d.text AS description,
    CASE WHEN d.doc_id % 97 = 0 THEN 'x' ELSE CAST(d.n_chars % 2 AS VARCHAR) END AS telecommuting,
    CASE WHEN d.doc_id % 211 = 0 THEN NULL WHEN d.doc_id % 3 = 0 THEN '1' ELSE '0' END
      AS has_company_logo,
    CASE WHEN d.text LIKE '%?%' THEN '1' ELSE '0' END AS has_questions,
    CASE WHEN d.doc_id % 10 = 0 THEN NULL ELSE d.source END AS benefits,
    CASE WHEN d.doc_id % 101 = 0 THEN 'bad row' ELSE CAST(1 - l.quality AS VARCHAR) END
      AS fraudulent
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""

VALID = (
    POSTINGS
    + """,
valid AS (
  SELECT * REPLACE (TRY_CAST(fraudulent AS INTEGER) AS fraudulent) FROM postings
  WHERE TRY_CAST(fraudulent AS INTEGER) IN (0, 1))"""
)

FLAGS = (
    POSTINGS
    + """,
flags AS (
  SELECT job_id,
    CASE WHEN regexp_full_match(telecommuting, '[0-9]+')
      THEN TRY_CAST(telecommuting AS INTEGER) END AS telecommuting,
    CASE WHEN regexp_full_match(has_company_logo, '[0-9]+')
      THEN TRY_CAST(has_company_logo AS INTEGER) END AS has_company_logo,
    CASE WHEN regexp_full_match(has_questions, '[0-9]+')
      THEN TRY_CAST(has_questions AS INTEGER) END AS has_questions
  FROM postings)"""
)

RATINGS = """ratings AS (
  SELECT o_custkey AS user_id, l_suppkey AS item_id,
    CAST(ceil(avg(l_quantity) / 10) AS INTEGER) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""

DIRTY = """dirty AS (
  SELECT *, CASE kind
      WHEN 'fields' THEN CASE WHEN (user_id * 31 + item_id) % 11 = 0 THEN concat(user_id, ',', item_id)
        ELSE concat(user_id, ',', item_id, ',', rating, ',0,more') END
      WHEN 'user_id' THEN concat('u', user_id, ',', item_id, ',', rating, ',0')
      WHEN 'item_id' THEN concat(user_id, ',,', rating, ',0')
      WHEN 'rating' THEN concat(user_id, ',', item_id, ',good,0') END AS line
  FROM (
    SELECT *, CASE WHEN (user_id * 31 + item_id) % 11 = 0 OR (user_id * 31 + item_id) % 13 = 0 THEN 'fields'
      WHEN (user_id * 31 + item_id) % 17 = 0 THEN 'user_id' WHEN (user_id * 31 + item_id) % 19 = 0 THEN 'item_id'
      WHEN (user_id * 31 + item_id) % 23 = 0 THEN 'comma' WHEN (user_id * 31 + item_id) % 29 = 0 THEN 'rating'
      ELSE 'good' END AS kind
    FROM ratings))"""

ITEMS = """items AS (
  SELECT s_suppkey AS item_id, concat(s_name, ' (', n_name, ')') AS title,
    concat(r_name, '|', n_name) AS genres
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

LEXICON = """lexicon AS (
  SELECT term, CAST(count(*) % 3 - 1 AS DOUBLE) AS polarity FROM (
    SELECT DISTINCT doc_id, unnest(string_split_regex(lower(text), '[^a-z]+')) AS term
    FROM documents WHERE lang = 'en')
  WHERE term <> '' GROUP BY term HAVING count(*) >= 20)"""


def _bits(key: str) -> str:
    return f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT)"


SPLIT = (
    RATINGS
    + f""",
parted AS (
  SELECT *, {_bits("user_id || ':' || item_id")} % 100 < 80 AS is_train FROM ratings),
train AS (SELECT user_id, item_id, rating FROM parted WHERE is_train),
test AS (SELECT user_id, item_id, rating FROM parted WHERE NOT is_train),
im AS (SELECT item_id, avg(rating) AS m FROM train GROUP BY 1),
um AS (SELECT user_id, avg(rating) AS m FROM train GROUP BY 1),
g AS (SELECT round(avg(m), 9) AS m FROM im)"""
)

BASELINE = (
    SPLIT
    + """,
base AS (
  SELECT t.user_id, t.item_id, t.rating,
    coalesce(um.m, g.m) + coalesce(im.m - g.m, 0.0) AS b
  FROM test t CROSS JOIN g LEFT JOIN im USING (item_id) LEFT JOIN um USING (user_id))"""
)

# The same over ids beyond INT and ratings less half a star.
LARGE_BASELINE = BASELINE.replace(
    "parted AS (",
    """large AS (SELECT user_id + 3000000000 AS user_id, item_id + 3000000000 AS item_id,
  CAST(rating AS DOUBLE) - 0.5 AS rating FROM ratings),
parted AS (""",
).replace("AS is_train FROM ratings", "AS is_train FROM large")



def _similarity(source: str, means: str) -> str:
    return f"""centred AS (
  SELECT r.user_id, r.item_id, r.rating - m.m AS x FROM {source} r JOIN {means} m USING (item_id)),
pairs AS (
  SELECT a.item_id AS item_i, b.item_id AS item_j, sum(a.x * b.x) AS xy, sum(a.x * a.x) AS xx,
    sum(b.x * b.x) AS yy, count(*) AS support
  FROM centred a JOIN centred b ON a.user_id = b.user_id AND a.item_id < b.item_id
  GROUP BY 1, 2),
sims AS (
  SELECT item_i, item_j, support,
    round(CASE WHEN xx > 0 AND yy > 0 THEN xy / (sqrt(xx) * sqrt(yy)) ELSE 0.0 END, 6)
      AS similarity
  FROM pairs)"""


ALL_SIMS = (
    RATINGS
    + ", im AS (SELECT item_id, avg(rating) AS m FROM ratings GROUP BY 1), "
    + _similarity("ratings", "im")
)

NEAREST = (
    BASELINE
    + ", "
    + _similarity("train", "im")
    + """,
both_ways AS (
  SELECT item_i AS i, item_j AS j, similarity FROM sims
  UNION ALL SELECT item_j, item_i, similarity FROM sims),
near AS (
  SELECT t.user_id, t.item_id, r.item_id AS neighbour, s.similarity,
    r.rating - (um.m + (im.m - g.m)) AS residual,
    row_number() OVER (PARTITION BY t.user_id, t.item_id
      ORDER BY s.similarity DESC, r.item_id) AS rank
  FROM test t JOIN train r ON r.user_id = t.user_id
  JOIN both_ways s ON s.i = t.item_id AND s.j = r.item_id
  JOIN im ON im.item_id = r.item_id JOIN um ON um.user_id = r.user_id CROSS JOIN g
  QUALIFY rank <= 10)"""
)

CF = (
    NEAREST
    + """,
shift AS (
  SELECT user_id, item_id, sum(similarity * residual) AS pull, sum(abs(similarity)) AS weight
  FROM near GROUP BY 1, 2),
cf AS (
  SELECT b.user_id, b.item_id, b.rating,
    round(b.b + CASE WHEN s.weight > 0 THEN s.pull / s.weight ELSE 0.0 END, 6) AS prediction
  FROM base b LEFT JOIN shift s USING (user_id, item_id))"""
)

ITEM_MEAN = """itemwise AS (
  SELECT t.user_id, t.item_id, t.rating, round(coalesce(im.m, g.m), 6) AS prediction
  FROM test t CROSS JOIN g LEFT JOIN im USING (item_id)),
basewise AS (SELECT user_id, item_id, rating, round(b, 6) AS prediction FROM base)"""


def _regression(source: str) -> str:
    stats = f"""stats AS (
  SELECT avg((rating - prediction) * (rating - prediction)) AS mse,
    1.0 - avg((rating - prediction) * (rating - prediction)) / var_pop(rating) AS r2
  FROM {source})"""
    return f"""{stats}
SELECT 'rmse' AS metric, round(sqrt(mse), 6) AS value FROM stats
UNION ALL SELECT 'mse', round(mse, 6) FROM stats
UNION ALL SELECT 'r2', round(r2, 6) FROM stats"""


WS = r"[ \t\n\x0B\f\r]"
STOP_LIST = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS)


def _prose(column: str) -> str:
    letters = rf"regexp_replace({column}, '[^a-zA-Z \t\n\x0B\f\r]', '', 'g')"
    return f"lower(regexp_replace({letters}, '{WS}{WS}+', ' ', 'g'))"


def _only(pattern: str, column: str, instead: str = "") -> str:
    return f"lower(regexp_replace({column}, '{pattern}', '{instead}', 'g'))"


TF = f"""words AS (
  SELECT doc_id, unnest(string_split_regex({_prose("text")}, '{WS}')) AS term FROM documents),
tf AS (
  SELECT doc_id, term, count(*) AS tf FROM words
  WHERE term <> '' AND term NOT IN ({STOP_LIST}) GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
m AS (SELECT CAST(count(*) AS DOUBLE) AS m FROM documents),
tfidf AS (
  SELECT doc_id, term, tf, df,
    round(CAST(tf AS DOUBLE) * ln((m + 1.0) / (CAST(df AS DOUBLE) + 1.0)), 6) AS tfidf
  FROM tf JOIN df USING (term) CROSS JOIN m)"""

PUNCTUATION = "!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~"
BLANKS = " " * 32
MARKUP = (
    "translate(lower(regexp_replace(replace(replace(html, chr(10), ' '), chr(92), ''), "
    f"'<.*?>', '', 'g')), '{PUNCTUATION}', '{BLANKS}')"
)

LANGUAGE = r"""words AS (
  SELECT * FROM (
    SELECT doc_id, lang, unnest(string_split_regex(lower(text), '[^a-zà-ÿ]+')) AS term
    FROM documents) WHERE term <> ''),
c AS (SELECT lang, term, count(*) AS c FROM words GROUP BY 1, 2),
n AS (SELECT lang, sum(c) AS n FROM c GROUP BY 1),
doc_words AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY 1, 2),
scores AS (
  SELECT w.doc_id, n.lang,
    round(sum(w.tf * ln((coalesce(c.c, 0) + 1.0) / (n.n + 1000.0))), 4) AS score
  FROM doc_words w CROSS JOIN n LEFT JOIN c ON c.term = w.term AND c.lang = n.lang
  GROUP BY 1, 2),
best AS (
  SELECT doc_id, lang, score FROM scores
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) = 1),
found AS (
  SELECT d.doc_id, coalesce(b.lang, 'none') AS lang, coalesce(b.score, 0.0) AS score
  FROM documents d LEFT JOIN best b USING (doc_id))"""

# Two texts of three have a label.
SOME_LABELS = LANGUAGE.replace(
    "FROM words GROUP BY 1, 2),\nn AS", "FROM words WHERE doc_id % 3 > 0 GROUP BY 1, 2),\nn AS"
)

SENTIMENT = (
    LEXICON
    + """,
words AS (
  SELECT doc_id, unnest(string_split_regex(lower(text), '[^a-z]+')) AS term
  FROM documents WHERE lang = 'en'),
scored AS (
  SELECT doc_id, round(coalesce(avg(polarity), 0.0), 6) AS polarity,
    CAST(coalesce(avg(polarity), 0.0) > 0 AS INTEGER) AS sentiment
  FROM words LEFT JOIN lexicon USING (term) GROUP BY 1)"""
)


def _profile(columns: list[str]) -> str:
    one = (
        "SELECT '{c}' AS column_name, count(*) AS row_count, "
        "count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        "count(*) FILTER (WHERE CAST({c} AS VARCHAR) LIKE '%' || chr(10) || '%') "
        "AS newline_count FROM postings"
    )
    return " UNION ALL ".join(one.format(c=c) for c in columns)


POSTING_COLUMNS = (
    "job_id title description telecommuting has_company_logo has_questions benefits fraudulent"
).split()
FLAG_COLUMNS = ["telecommuting", "has_company_logo", "has_questions"]


def _filled(kind: str) -> str:
    means = ", ".join(f"avg({c}) AS {c}" for c in FLAG_COLUMNS)
    value = {
        "double": "round(coalesce(CAST(f.{c} AS DOUBLE), m.{c}), 6)",
        "int": "coalesce(f.{c}, CAST(trunc(m.{c}) AS INTEGER))",
    }[kind]
    picked = ", ".join(f"{value.format(c=c)} AS {c}" for c in FLAG_COLUMNS)
    return f"m AS (SELECT {means} FROM flags) SELECT f.job_id, {picked} FROM flags f CROSS JOIN m"

ENGLISH_WORDS = (
    "spoken AS (SELECT doc_id, unnest(string_split_regex(lower("
    + _only("[^a-zA-Z+ ]", "text")
    + f"), '{WS}')) AS term FROM documents WHERE lang = 'en'),"
    f" english_words AS (SELECT DISTINCT doc_id, term FROM spoken WHERE term <> '' AND term NOT IN ({STOP_LIST}))"
)


ORACLES: dict[str, str] = {
    "csv_postings": f"WITH {POSTINGS} SELECT CAST(job_id AS VARCHAR) AS job_id, * EXCLUDE (job_id)"
    " REPLACE (TRY_CAST(fraudulent AS INTEGER) AS fraudulent) FROM postings",
    "csv_tweets": "SELECT doc_id, text AS tweet, lang FROM documents WHERE text IS NOT NULL",
    "csv_ratings": f"WITH {RATINGS} SELECT user_id, item_id,"
    " CAST(rating AS DOUBLE) - 0.5 AS rating FROM ratings",
    "large_id_baseline": f"WITH {LARGE_BASELINE} SELECT user_id, item_id, rating,"
    " round(b, 6) AS prediction FROM base",
    "native_random_split": "SELECT doc_id AS job_id, CAST(1 AS BIGINT) AS copies,"
    " TRUE AS shares_hold FROM documents",
    "csv_item_names": f"WITH {RATINGS}, {ITEMS} SELECT item_id, title,"
    " count(*) AS n_ratings FROM ratings JOIN items USING (item_id) GROUP BY 1, 2",
    "handed_over_predictions": f"WITH {BASELINE} SELECT user_id, item_id,"
    " CAST(rating AS DOUBLE) AS rating, round(b, 6) AS prediction FROM base",
    "headerless_predictions": f"WITH {BASELINE} SELECT user_id, item_id,"
    " CAST(rating AS DOUBLE) AS rating, round(b, 6) AS prediction FROM base",
    "null_profile": f"WITH {POSTINGS} {_profile(POSTING_COLUMNS)}",
    "row_count": "SELECT count(*) AS row_count FROM documents",
    "valid_class_filter": f"WITH {VALID} SELECT job_id, fraudulent FROM valid",
    "drop_sparse_columns": f"WITH {VALID} SELECT * EXCLUDE (benefits) FROM valid",
    "class_balance": f"WITH {VALID} SELECT fraudulent, count(*) AS row_count FROM valid GROUP BY 1",
    "clean_flags": f"WITH {FLAGS} SELECT * FROM flags",
    "impute_mean": f"WITH {FLAGS}, {_filled('double')}",
    "impute_whole_mean": f"WITH {FLAGS}, {_filled('int')}",
    "hash_split": f"SELECT doc_id AS job_id, CASE WHEN {_bits('doc_id')} % 100 < 70 THEN 0 ELSE 1"
    " END AS part FROM documents",
    "stratified_hash_sample": f"WITH {VALID} SELECT job_id, fraudulent FROM valid WHERE"
    f" {_bits('job_id')} / 4294967296.0 < CASE fraudulent WHEN 0 THEN 0.055 ELSE 1.0 END",
    "clean_text": f"WITH {POSTINGS} SELECT job_id, {_prose('title')} AS title,"
    f" regexp_replace({_prose('title')}, '{WS}+', '', 'g') AS title_squashed,"
    f" {_prose('description')} AS description FROM postings",
    "clean_tweet": f"SELECT doc_id, {_only('[^a-zA-Z+ ]', 'text')} AS tweet FROM documents",
    "clean_items": f"WITH {ITEMS} SELECT item_id, {_only('[^a-zA-Z0-9 ]', 'title')} AS title,"
    f" {_only('[^a-zA-Z0-9 -]', 'genres', ' ')} AS genres FROM items",
    "strip_markup": f"SELECT page_id, {MARKUP} AS body FROM pages",
    "stop_word_filter": f"WITH w AS (SELECT page_id, list_filter(string_split({MARKUP}, ' '),"
    f" lambda t: t <> '' AND t NOT IN ({STOP_LIST})) AS w FROM pages) SELECT page_id,"
    " CAST(len(w) AS INTEGER) AS n_words, array_to_string(w, ' ') AS words FROM w",
    "tokens": "WITH t AS (SELECT doc_id,"
    f" string_split_regex(regexp_replace({_prose('text')}, '{WS}+$', ''), '{WS}') AS t"
    f" FROM documents), w AS (SELECT doc_id, t, list_filter(t, lambda x: x <> '' AND x NOT IN"
    f" ({STOP_LIST})) AS w FROM t) SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens,"
    " CAST(len(w) AS INTEGER) AS n_words, array_to_string(w, '|') AS words FROM w",
    "term_counts": f"WITH {TF} SELECT term, CAST(sum(tf) AS BIGINT) AS occurrences,"
    " count(*) AS df FROM tf GROUP BY 1",
    "vocabulary_size": f"WITH {TF} SELECT count(*) AS vocabulary_size FROM df",
    "tfidf_long": f"WITH {TF} SELECT doc_id, term, tf, df, tfidf FROM tfidf",
    "count_vectors": f"WITH {TF} SELECT doc_id, term, tfidf FROM tfidf",
    "language_id": f"WITH {LANGUAGE} SELECT doc_id, lang, score FROM found",
    "unlabelled_language_id": f"WITH {SOME_LABELS} SELECT doc_id, lang, score FROM found",
    "english_filter": f"WITH {LANGUAGE} SELECT d.doc_id, d.text AS tweet, f.lang FROM documents d"
    " JOIN found f USING (doc_id) WHERE f.lang = 'en'",
    "sentiment_score": f"WITH {SENTIMENT} SELECT * FROM scored",
    "sentiment_balance": f"WITH {SENTIMENT} SELECT sentiment, count(*) AS row_count FROM scored"
    " GROUP BY 1",
    "ratings_with_items": f"WITH {RATINGS}, {ITEMS} SELECT item_id, user_id, rating,"
    f" {_only('[^a-zA-Z0-9 ]', 'title')} AS title, {_only('[^a-zA-Z0-9 -]', 'genres', ' ')}"
    " AS genres FROM ratings JOIN items USING (item_id)",
    "item_rating_totals": f"WITH {RATINGS} SELECT item_id, count(*) AS n_ratings,"
    " CAST(sum(rating) AS BIGINT) AS rating_sum FROM ratings GROUP BY 1",
    "item_means": f"WITH {RATINGS} SELECT item_id, round(avg(rating), 6) AS item_mean FROM ratings"
    " GROUP BY 1",
    "user_means": f"WITH {RATINGS}, im AS (SELECT item_id, avg(rating) AS m FROM ratings"
    " GROUP BY 1) SELECT user_id, round(avg(rating), 6) AS user_mean,"
    " round(avg(rating - m), 6) AS residual_mean FROM ratings JOIN im USING (item_id) GROUP BY 1",
    "global_mean": f"WITH {RATINGS}, im AS (SELECT item_id, avg(rating) AS m FROM ratings"
    " GROUP BY 1) SELECT round(avg(m), 6) AS global_mean FROM im",
    "item_similarity": f"WITH {ALL_SIMS} SELECT item_i, item_j, similarity, support FROM sims",
    "supported_similarity": f"WITH {ALL_SIMS} SELECT item_i, item_j, similarity, support FROM sims"
    " WHERE support >= 150",
    "baseline_prediction": f"WITH {BASELINE} SELECT user_id, item_id, rating,"
    " round(b, 6) AS prediction FROM base",
    "nearest_neighbours": f"WITH {NEAREST} SELECT user_id, item_id, CAST(rank AS INTEGER) AS rank,"
    " neighbour, similarity FROM near",
    "cf_predictions": f"WITH {CF} SELECT user_id, item_id, rating, prediction FROM cf",
    "cf_metrics": f"WITH {CF}, {_regression('cf')}",
    "blend_two": f"WITH {BASELINE}, {ITEM_MEAN} SELECT user_id, item_id, rating,"
    " b.prediction * 0.3::DOUBLE + i.prediction * 0.7::DOUBLE AS prediction"
    " FROM basewise b JOIN itemwise i USING (user_id, item_id, rating)",
    "blend_three": f"WITH {CF}, {ITEM_MEAN} SELECT user_id, item_id, rating,"
    " (b.prediction * 0.3::DOUBLE + i.prediction * 0.7::DOUBLE) * 0.8::DOUBLE"
    " + cf.prediction * 0.2::DOUBLE AS prediction FROM basewise b"
    " JOIN itemwise i USING (user_id, item_id, rating) JOIN cf USING (user_id, item_id, rating)",
    "regression_metrics": f"WITH {BASELINE}, {ITEM_MEAN}, {_regression('basewise')}",
    "confusion_metrics": f"""WITH {VALID},
scored AS (
  SELECT fraudulent AS label, coalesce(TRY_CAST(has_company_logo AS INTEGER), 0) AS prediction
  FROM valid),
per_class AS (
  SELECT c.cls, CAST(count(*) FILTER (WHERE label = cls AND prediction = cls) AS DOUBLE) AS tp,
    CAST(count(*) FILTER (WHERE label = cls) AS DOUBLE) AS support,
    CAST(count(*) FILTER (WHERE prediction = cls) AS DOUBLE) AS called
  FROM scored CROSS JOIN (
    SELECT DISTINCT label AS cls FROM scored UNION SELECT DISTINCT prediction FROM scored) c
  GROUP BY 1),
stats AS (
  SELECT sum(tp) / sum(support) AS accuracy,
    sum(support * CASE WHEN support + called > 0 THEN 2 * tp / (support + called) ELSE 0 END)
      / sum(support) AS f1,
    sum(support * CASE WHEN called > 0 THEN tp / called ELSE 0 END) / sum(support) AS wp,
    sum(support * CASE WHEN support > 0 THEN tp / support ELSE 0 END) / sum(support) AS wr
  FROM per_class)
SELECT 'accuracy' AS metric, round(accuracy, 6) AS value FROM stats
UNION ALL SELECT 'f1', round(f1, 6) FROM stats
UNION ALL SELECT 'weighted_precision', round(wp, 6) FROM stats
UNION ALL SELECT 'weighted_recall', round(wr, 6) FROM stats""",
    "auc_rank": f"""WITH {VALID},
ranked AS (
  SELECT fraudulent AS label,
    rank() OVER (ORDER BY length(description))
      + (count(*) OVER (PARTITION BY length(description)) - 1) / 2.0 AS r
  FROM valid),
stats AS (
  SELECT CAST(sum(r) FILTER (WHERE label = 1) AS DOUBLE) AS rank_sum,
    CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS p,
    CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE) AS n
  FROM ranked)
SELECT 'area_under_roc' AS metric, round((rank_sum - p * (p + 1) / 2) / (p * n), 6) AS value
FROM stats""",
    "auc_missing_scores": f"""WITH {VALID},
ranked AS (
  SELECT fraudulent AS label,
    rank() OVER (ORDER BY length(description))
      + (count(*) OVER (PARTITION BY length(description)) - 1) / 2.0 AS r
  FROM valid WHERE job_id % 5 > 0),
stats AS (
  SELECT CAST(sum(r) FILTER (WHERE label = 1) AS DOUBLE) AS rank_sum,
    CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS p,
    CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE) AS n
  FROM ranked)
SELECT 'area_under_roc' AS metric, round((rank_sum - p * (p + 1) / 2) / (p * n), 6) AS value
FROM stats""",
    "dirty_ratings": f"WITH {RATINGS}, {DIRTY} SELECT user_id, item_id, CASE WHEN kind = 'comma' THEN 4.0"
    " ELSE CAST(rating AS DOUBLE) END AS rating FROM dirty WHERE kind IN ('good', 'comma')",
    "rejected_ratings": f"WITH {RATINGS}, {DIRTY} SELECT kind AS reason, count(*) AS n_rows,"
    " count(DISTINCT line) AS n_lines FROM dirty WHERE kind NOT IN ('good', 'comma') GROUP BY 1",
    **{
        f"{name}_rows": f"WITH {VALID} SELECT job_id, CAST(fraudulent AS DOUBLE) AS label, TRUE AS classed"
        f" FROM valid WHERE {_bits("'split:' || job_id")} % 100 >= 70"
        for name in ("logistic", "svc", "forest", "mlp")
    },
    "topic_terms_covered": f"WITH {ENGLISH_WORDS} SELECT term, CAST(5 AS BIGINT) AS n_topics,"
    " TRUE AS weighted FROM (SELECT DISTINCT term FROM english_words)",
    "doc_topic_sums": f"WITH {ENGLISH_WORDS} SELECT d.doc_id,"
    " CAST(5 * CAST(d.doc_id IN (SELECT doc_id FROM english_words) AS INTEGER) AS BIGINT) AS n_topics, CAST(d.doc_id IN (SELECT doc_id FROM english_words) AS DOUBLE) AS share_sum"
    " FROM documents d WHERE d.lang = 'en'",
    "als_rows": f"WITH {SPLIT} SELECT user_id, item_id, CAST(rating AS DOUBLE) AS rating, TRUE AS scored FROM test",
    "regression_rows": f"WITH {SPLIT} SELECT user_id, item_id, CAST(rating AS DOUBLE) AS rating,"
    " TRUE AS scored FROM test",
    "hybrid_rows": f"WITH {SPLIT} SELECT user_id, item_id, CAST(rating AS DOUBLE) AS rating, TRUE AS scored FROM test",
    "cold_start_rows": f"WITH {SPLIT} SELECT user_id IN (SELECT user_id FROM train) AS user_known,"
    " item_id IN (SELECT item_id FROM train) AS item_known, count(*) AS n_rows FROM test GROUP BY 1, 2",
    "als_top_n_sizes": f"WITH {SPLIT}, n AS (SELECT least(10, count(DISTINCT item_id)) AS n FROM train)"
    " SELECT DISTINCT user_id, n AS n_items, CAST(n AS INTEGER) AS last_rank FROM test CROSS JOIN n"
    " WHERE user_id IN (SELECT user_id FROM train)",
}
