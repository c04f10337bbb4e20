import pytest
from pyspark.sql import functions as F

from tallyloom import store
from tallyloom.functions import casts, keys
from tallyloom.operators import factorise
from tallyloom.plans import ratings
from tallyloom.sources import readers, writers


def put(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


HEADER = "job_id,title,description,telecommuting,has_company_logo,has_questions,fraudulent\n"


def test_postings_with_quoted_newline_doubled_quote_and_bad_label(spark, tmp_path):
    path = put(
        tmp_path / "p.csv",
        HEADER
        + '1,"A ""big"" job","two\nlines",0,1,0,0\n'
        + "2,plain,text,1,,0,1\n"
        + "3,bad,label,0,1,0,4.5\n"
        + "4,short row\n",
    )
    rows = {r.job_id: r for r in readers.read_postings(spark, path).collect()}
    assert rows["1"].title == 'A "big" job' and rows["1"].description == "two\nlines"
    assert rows["2"].has_company_logo is None and rows["2"].fraudulent == 1
    assert rows["3"].fraudulent is None
    assert rows["4"].title == "short row" and rows["4"].fraudulent is None


def test_corrupt_rows_can_be_kept(spark, tmp_path):
    path = put(tmp_path / "c.csv", "a,b\n1,2\n3\n4,5,6\n")
    rows = readers.read_csv(spark, path, ["a", "b"], keep_corrupt=True).cache()
    assert {r[readers.CORRUPT] for r in rows.collect()} == {None, "3", "4,5,6"}


def test_header_only_file_is_empty(spark, tmp_path):
    path = put(tmp_path / "e.csv", HEADER)
    assert readers.read_postings(spark, path).count() == 0


def test_missing_columns_are_reported(spark, tmp_path):
    with pytest.raises(ValueError, match="fraudulent"):
        readers.read_postings(spark, put(tmp_path / "m.csv", "job_id,title\n1,x\n"))


def test_tweets_drop_rows_without_text(spark, tmp_path):
    path = put(tmp_path / "t.csv", 'tweet,lang\n"one\ntwo",en\n,de\n')
    rows = readers.read_tweets(spark, path).collect()
    assert [(r.tweet, r.lang) for r in rows] == [("one\ntwo", "en")]


@pytest.mark.parametrize("sep", [",", "\t"])
def test_ratings_keep_half_stars(spark, tmp_path, sep):
    text = "\n".join(
        sep.join(r)
        for r in [
            ("userId", "movieId", "rating", "timestamp"),
            ("1", "10", "4.5", "99"),
            ("x", "10", "4", "99"),
        ]
    )
    rows = readers.read_ratings(spark, put(tmp_path / "r.csv", text), sep=sep).collect()
    assert [tuple(r) for r in rows] == [(1, 10, 4.5)]


def test_ratings_with_ids_beyond_int(spark, tmp_path):
    big = 3_000_000_000
    lines = ["userId,movieId,rating,timestamp"]
    lines += [f"{big + u},{big + i},{(u + i) % 5 + 0.5},9" for u in range(30) for i in range(11)]
    rows = readers.read_ratings(spark, put(tmp_path / "r.csv", "\n".join(lines)))
    assert rows.count() == 330
    data = ratings.split_ratings(rows)
    found = ratings.baseline_predictions(data)
    assert found.count() == data.test.count() > 0
    factors = factorise.fit(data.train, {"maxIter": [2], "rank": [2], "regParam": [0.1]}, 2)
    scored = factorise.predict(factors, data.test).collect()
    assert scored and all(r.user_id >= big and r.item_id >= big for r in scored)
    assert all(r.item_id >= big for r in factorise.top_items(factors, data.test, 2).collect())


def test_a_header_with_other_columns_is_an_error(spark, tmp_path):
    path = put(tmp_path / "r.csv", "movieId,userId,rating,timestamp\n1,2,3,4\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        readers.read_ratings(spark, path).collect()


def test_items_in_latin1_with_pipe_genres(spark, tmp_path):
    text = 'movieId,title,genres\n1,"Amélie, the film",Comedy|Sci-Fi\n'
    path = put(tmp_path / "i.csv", text, "ISO-8859-1")
    row = readers.read_items(spark, path, encoding="ISO-8859-1").first()
    assert tuple(row) == (1, "Amélie, the film", "Comedy|Sci-Fi")


def test_csv_writer_fails_on_existing_target_unless_told(spark, tmp_path):
    df = spark.createDataFrame([(" spaced ", 'q"uote', "two\nlines")], "a string, b string, c string")
    path = str(tmp_path / "out")
    writers.write_csv(df, path)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        writers.write_csv(df, path)
    writers.write_csv(df, path, overwrite=True)
    back = readers.read_csv(spark, path, ["a", "b", "c"], multi_line=True)
    assert back.collect() == df.collect()


def test_casts(spark):
    df = spark.createDataFrame([("7",), ("-1",), ("1.0",), ("x",), ("",), (None,)], "v string")
    rows = df.select(
        "v",
        casts.flag_or_null(F.col("v")).alias("flag"),
        casts.int_or_null(F.col("v")).alias("whole"),
        casts.whole_part(F.col("v")).alias("part"),
    ).collect()
    assert [r.flag for r in rows] == [7, None, None, None, None, None]
    assert [r.whole for r in rows] == [7, -1, None, None, None, None]
    assert [r.part for r in rows] == [7, -1, 1, None, None, None]
    odd = spark.createDataFrame([("-4.5",), ("4.5",), ("1e300",), ("NaN",), ("1\n",)], "v string")
    rows = odd.select(casts.whole_part(F.col("v")), casts.flag_or_null(F.col("v"))).collect()
    assert [r[0] for r in rows][:4] == [-4, 4, None, None] and {r[1] for r in rows} == {None}


def test_dense_ids(spark):
    df = spark.createDataFrame([(i * 10**12,) for i in range(50)] * 2 + [(None,)], "a long")
    rows = keys.dense_ids(df, "a", "n").collect()
    assert sorted((r.a, r.n) for r in rows) == [(i * 10**12, i) for i in range(50)]


def test_materialise_reads_back_from_files(spark):
    df = spark.range(5)
    table = store.materialise(df, "five")
    assert sorted(r.id for r in table.collect()) == [0, 1, 2, 3, 4]
    assert table.inputFiles()


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is not None:
        assert store.shared_folder(spark) == named
