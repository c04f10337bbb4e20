from pyspark.ml.feature import Imputer
from pyspark.sql import functions as F

from tallyloom.functions import keys
from tallyloom.operators import missing, profile, sampling


def test_key_bits_are_the_md5_prefix(spark):
    assert spark.range(7, 8).select(keys.key_bits(F.col("id"))).first()[0] == 2400511071


def test_hash_split_is_a_partition_and_repeatable(spark):
    df = spark.range(1000)
    parts = sampling.hash_split(df, F.col("id"), [70, 20, 10])
    ids = [sorted(r.id for r in p.collect()) for p in parts]
    assert sorted(sum(ids, [])) == list(range(1000))
    again = sampling.hash_split(df.repartition(13), F.col("id"), [70, 20, 10])
    assert [sorted(r.id for r in p.collect()) for p in again] == ids
    assert 600 < len(ids[0]) < 800


def test_folds_are_filled_after_the_split(spark):
    train = sampling.hash_split(spark.range(2000), F.col("id"), [80, 20])[0]
    folds = train.groupBy(keys.fold_number(F.col("id"), 5).alias("f")).count().collect()
    assert sorted(r.f for r in folds) == [0, 1, 2, 3, 4]
    assert all(r["count"] > 200 for r in folds)


def test_sample_by_takes_keys_of_another_type(spark):
    df = spark.createDataFrame([("0",)] * 50 + [("1",)] * 50, "label string")
    sample = sampling.native_sample_by(df, "label", {0: 1.0, 1: 0.0})
    assert sample.count() == 50


def test_stratified_sample_keeps_whole_classes(spark):
    df = spark.range(400).withColumn("label", (F.col("id") % 4 == 0).cast("int"))
    rows = sampling.stratified_hash_sample(df, "label", {0: 0.1, 1: 1}, F.col("id"))
    counts = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    assert counts[1] == 100 and 10 < counts[0] < 60
    assert sampling.balancing_fractions(df, "label") == {0: 100 / 300, 1: 1.0}


def test_imputation_equals_mllib_and_all_null_column_stays_null(spark):
    df = spark.createDataFrame(
        [(1, 1.0, None), (2, None, None), (3, 0.0, None), (4, 1.0, None)],
        "id int, a double, b double",
    )
    ours = {r.id: r.a for r in missing.impute_mean(df, ["a"]).collect()}
    model = Imputer(inputCols=["a"], outputCols=["a"]).fit(df)
    assert ours == {r.id: r.a for r in model.transform(df).collect()}
    assert [r.b for r in missing.impute_mean(df, ["b"]).collect()] == [None] * 4
    whole = missing.impute_mean(df.withColumn("a", F.col("a").cast("int")), ["a"], whole=True)
    assert {r.id: r.a for r in whole.collect()}[2] == 0


def test_imputation_reads_all_means_in_one_pass(spark):
    df = spark.range(10).selectExpr("id", "double(id) a", "double(id) b", "double(id) c")
    out = missing.impute_mean(df, ["a", "b", "c"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") <= 3


def test_sparse_columns_use_a_strict_limit(spark):
    df = spark.range(100).select(
        "id",
        F.when(F.col("id") >= 1, 1).alias("one_missing"),
        F.when(F.col("id") >= 2, 1).alias("two_missing"),
        F.lit(None).cast("string").alias("none"),
    )
    assert profile.sparse_columns(df) == ["two_missing", "none"]
    assert profile.drop_sparse_columns(df).columns == ["id", "one_missing"]


def test_null_profile(spark):
    df = spark.createDataFrame([("a\nb", None), (None, None), ("c", 1)], "t string, n int")
    rows = {r.column_name: tuple(r)[1:] for r in profile.null_profile(df).collect()}
    assert rows == {"t": (3, 1, 1), "n": (3, 2, 0)}


def test_valid_classes_drop_nulls_and_others(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "y int")
    assert sorted(r.y for r in profile.valid_classes(df, "y").collect()) == [0, 1]
    assert profile.feature_columns(df.withColumn("x", F.lit(1)), ["y"]) == ["x"]
