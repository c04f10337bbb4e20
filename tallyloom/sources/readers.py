"""CSV readers. Every column arrives as text and is cast by name; bad text becomes NULL.

A file with quoted newlines cannot be split, so it is one task: feed many files of moderate
size, and convert to Parquet (``writers.write_table``) before running anything twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyloom.functions import casts

CORRUPT = "_corrupt_record"


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    sep: str = ",",
    header: bool = True,
    multi_line: bool = False,
    encoding: str = "UTF-8",
    keep_corrupt: bool = False,
) -> DataFrame:
    """All-text CSV scan.

    ``columns`` fixes the names and saves the job that reads the header; without it they
    come from the header line. A header that names other columns, or in another order, is an
    error. With ``keep_corrupt`` the raw text of a row with the wrong
    number of fields is kept in ``_corrupt_record``.
    """
    reader = (
        spark.read.option("sep", sep)
        .option("header", header)
        .option("multiLine", multi_line)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
    )
    if columns is not None:
        schema = text_schema(columns)
        if keep_corrupt:
            schema = schema.add(CORRUPT, T.StringType())
            # With pruned columns Spark does not see how many fields a row has.
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
        reader = reader.schema(schema).option("enforceSchema", not header)
    return reader.csv(path)


# The columns every postings file must have.
POSTING_COLUMNS = [
    "job_id",
    "title",
    "description",
    "telecommuting",
    "has_company_logo",
    "has_questions",
    "fraudulent",
]


def read_postings(
    spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Job postings: text columns, with ``fraudulent`` as INT (NULL when it is not one)."""
    raw = read_csv(spark, path, columns, multi_line=True)
    missing = [c for c in POSTING_COLUMNS if c not in raw.columns]
    if missing:
        raise ValueError(f"postings file lacks columns {missing}")
    return raw.withColumn("fraudulent", casts.int_or_null(F.col("fraudulent")))


def read_tweets(
    spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Tweets: rows without text go; other columns, such as ``lang``, stay."""
    return read_csv(spark, path, columns, multi_line=True).dropna(subset=["tweet"])


def read_ratings(
    spark: SparkSession, path: str | list[str], sep: str = ",", header: bool = True
) -> DataFrame:
    """Ratings file ``user, item, rating, timestamp``: BIGINT ids, half stars kept as DOUBLE.

    Rows with a field that is not a number, or without the file's number of fields, are left out;
    ``rejected_ratings`` has them with the reason.
    """
    raw = read_csv(
        spark, path, ["userId", "movieId", "rating", "timestamp"], sep=sep, header=header, keep_corrupt=True
    )
    return raw.where(F.col(CORRUPT).isNull()).select(
        casts.long_or_null(F.col("userId")).alias("user_id"),
        casts.long_or_null(F.col("movieId")).alias("item_id"),
        casts.double_or_null(F.col("rating")).alias("rating"),
    ).dropna()


def rejected_ratings(
    spark: SparkSession, path: str | list[str], sep: str = ",", header: bool = True
) -> DataFrame:
    """``(reason, line)`` of the rows that ``read_ratings`` leaves out, for a second output.

    ``reason`` is ``fields`` where a row has more or fewer fields than the file's columns, else the
    first column that is not a number; ``line`` is the row as the file has it.
    """
    raw = read_csv(
        spark, path, ["userId", "movieId", "rating", "timestamp"], sep=sep, header=header, keep_corrupt=True
    )
    numbers = {
        "user_id": casts.long_or_null(F.col("userId")),
        "item_id": casts.long_or_null(F.col("movieId")),
        "rating": casts.double_or_null(F.col("rating")),
    }
    reason = F.when(F.col(CORRUPT).isNotNull(), "fields")
    for name, number in numbers.items():
        reason = reason.when(number.isNull(), name)
    line = F.coalesce(CORRUPT, F.concat_ws(sep, *(F.coalesce(c, F.lit("")) for c in ("userId", "movieId", "rating", "timestamp"))))
    return raw.select(reason.alias("reason"), line.alias("line")).where("reason IS NOT NULL")


def read_items(
    spark: SparkSession, path: str | list[str], sep: str = ",", encoding: str = "UTF-8"
) -> DataFrame:
    """Item file ``item, title, genres`` with pipe-separated genres."""
    raw = read_csv(spark, path, ["movieId", "title", "genres"], sep=sep, encoding=encoding)
    return raw.select(
        casts.long_or_null(F.col("movieId")).alias("item_id"), "title", "genres"
    ).dropna(subset=["item_id"])


PREDICTION_SCHEMA = "user_id long, item_id long, rating double, prediction double"


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Predictions handed from one job to the next, typed."""
    return spark.read.schema(PREDICTION_SCHEMA).parquet(path)


def read_predictions_csv(spark: SparkSession, path: str) -> DataFrame:
    """The same from headerless CSV files, by position."""
    raw = read_csv(spark, path, ["user_id", "item_id", "rating", "prediction"], header=False)
    return raw.select(
        F.col("user_id").try_cast("bigint").alias("user_id"),
        F.col("item_id").try_cast("bigint").alias("item_id"),
        casts.double_or_null(F.col("rating")).alias("rating"),
        casts.double_or_null(F.col("prediction")).alias("prediction"),
    )
