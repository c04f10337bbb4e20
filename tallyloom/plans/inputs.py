"""Views that give the test tables the shapes the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.functions import text


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    """A table of texts, spread by key when its files give fewer tasks than there are cores.

    Cleaning text costs far more than reading it, so a small or badly split table would keep
    one core busy. A table with enough partitions is left as it is, without a shuffle.
    """
    df = table(spark, folder, name)
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)


def postings(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as job postings, with missing and dirty values put in by id."""
    d = texts(spark, folder, "documents", "doc_id")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    key = F.col("doc_id")
    return d.join(labels, "doc_id", "left").select(
        key.alias("job_id"),
        F.split_part("text", F.lit("."), F.lit(1)).alias("title"),
        F.col("text").alias("description"),
        F.when(key % 97 == 0, "x")
        .otherwise((F.col("n_chars") % 2).cast("string"))
        .alias("telecommuting"),
        F.when(key % 211 == 0, F.lit(None))
        .when(key % 3 == 0, "1")
        .otherwise("0")
        .alias("has_company_logo"),
        F.when(F.col("text").contains("?"), "1").otherwise("0").alias("has_questions"),
        F.when(key % 10 != 0, F.col("source")).alias("benefits"),
        F.when(key % 101 == 0, "bad row")
        .otherwise((1 - F.col("quality")).cast("string"))
        .alias("fraudulent"),
    )


def tweets(spark: SparkSession, folder: str) -> DataFrame:
    return texts(spark, folder, "documents", "doc_id").select("doc_id", F.col("text").alias("tweet"), "lang")


def lexicon(spark: SparkSession, folder: str) -> DataFrame:
    """Polarity by word for English words in 20 documents or more: arbitrary but fixed."""
    english = tweets(spark, folder).filter(F.col("lang") == "en")
    words = F.array_distinct(text.english_words(F.col("tweet")))
    counts = (
        english.select(F.explode(words).alias("term"))
        .filter(F.col("term") != "")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("docs"))
    )
    return counts.filter(F.col("docs") >= 20).select(
        "term", (F.col("docs") % 3 - 1).cast("double").alias("polarity")
    )


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Customers rate suppliers with a tenth of the mean quantity they bought."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_suppkey").alias("item_id"))
        .agg(F.ceil(F.avg("l_quantity") / 10).cast("int").alias("rating"))
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return (
        table(spark, folder, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("item_id"),
            F.concat("s_name", F.lit(" ("), "n_name", F.lit(")")).alias("title"),
            F.concat("r_name", F.lit("|"), "n_name").alias("genres"),
        )
    )
