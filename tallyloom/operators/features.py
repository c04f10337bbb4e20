"""Feature vectors from words and numbers, as MLlib stages."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.feature import IDF, CountVectorizer, HashingTF, Imputer, VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyloom import store
from tallyloom.functions import keys
from tallyloom.functions.vectors import vector_entries
from tallyloom.operators import terms


def hashed_tfidf(words: str, output: str, width: int) -> list:
    """Hashed term frequencies, then inverse document frequencies."""
    return [
        HashingTF(inputCol=words, outputCol=f"{output}_tf", numFeatures=width),
        IDF(inputCol=f"{output}_tf", outputCol=output),
    ]


def counted_tfidf(words: str, output: str, width: int) -> list:
    """The same with exact terms instead of hashes: all of them, if ``width`` is their number
    (``vocabulary_width``), or the most frequent ones."""
    return [
        CountVectorizer(inputCol=words, outputCol=f"{output}_tf", vocabSize=width),
        IDF(inputCol=f"{output}_tf", outputCol=output),
    ]


def imputer(columns: Sequence[str]) -> Imputer:
    """In-place mean imputation; bring the columns to DOUBLE first or the mean is truncated."""
    return Imputer(inputCols=list(columns), outputCols=list(columns))


def assembler(columns: Sequence[str], output: str = "features") -> VectorAssembler:
    """A missing input is an error: flags are imputed first, so no row is left out."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error")


def assembled(df: DataFrame, keep: Sequence[str], numbers: Sequence[str], vectors: dict[str, int], name: str) -> DataFrame:
    """``keep`` and ``features``: numbers and vectors (of the widths given) side by side, as a written table.

    What ``assembler`` gives, and as it stores it: without zeros, dense where that is shorter. But the
    assembler makes a name for every slot on the driver, some hundreds of bytes each, to be thrown away.
    """
    missing, entries, width = F.lit(False), [], 0
    for column in numbers:
        missing = missing | F.col(column).isNull() | F.isnan(column)
        entries.append(F.array(F.struct(F.lit(width).alias("index"), F.col(column).cast("double").alias("value"))))
        width += 1
    for column, size in vectors.items():
        missing = missing | F.col(column).isNull()
        entries.append(F.transform(vector_entries(F.col(column)), _moved(width)))
        width += size
    wrong = F.raise_error(F.lit("a feature is missing")).cast("array<struct<index:int,value:double>>")
    stored = F.when(missing, wrong).otherwise(F.filter(F.concat(*entries), lambda e: e["value"] != 0.0))
    rows = df.select(*keep, stored.alias("_e"))
    nothing = F.transform(
        F.array_except(F.sequence(F.lit(0), F.lit(width - 1)), F.col("_e")["index"]),
        lambda i: F.struct(i.alias("index"), F.lit(0.0).alias("value")),
    )
    every = F.array_sort(F.concat(F.col("_e"), nothing))["value"]
    dense = 1.5 * F.size("_e") + 2.0 >= width
    vector = F.struct(
        F.when(dense, 1).otherwise(0).cast("tinyint").alias("type"),
        F.when(~dense, width).cast("int").alias("size"),
        F.when(~dense, F.col("_e")["index"]).alias("indices"),
        F.when(dense, every).otherwise(F.col("_e")["value"]).alias("values"),
    )
    path = store.new_path(df.sparkSession, name)
    with store.shuffles_deleted(df.sparkSession):
        rows.select(*keep, vector.alias("features")).write.parquet(path)
    schema = T.StructType([*rows.select(*keep).schema, T.StructField("features", VectorUDT())])
    return df.sparkSession.read.schema(schema).parquet(path)


def _moved(by: int) -> Callable[[Column], Column]:
    return lambda e: F.struct((e["index"] + by).alias("index"), e["value"].alias("value"))


def bare(column: str = "features") -> Column:
    """The vector column without its attribute names.

    The assembler names every slot. Those names travel in the schema with every task of every
    iteration: at 50 000 slots that took four fifths of a fit. No learner here needs them.
    """
    return F.col(column).alias(column, metadata={})


def vocabulary_width(df: DataFrame, words: str) -> int:
    """Distinct terms in a word column, at least 1. Action: one count."""
    rows = df.select(F.explode(words).alias("term"))
    return max(1, terms.vocabulary_size(rows).first()[0])


@dataclass
class Counted:
    """Count vectors ``(key, counts)`` of documents, and the numbers ``(term, term_id)`` of all terms."""

    vectors: DataFrame
    ids: DataFrame
    width: int


def count_vectors(frequencies: DataFrame, docs: DataFrame, key: str) -> Counted:
    """Vectors over the whole vocabulary, which no single task and not the driver holds.

    ``frequencies`` is a written table ``(key, term, tf)``. Terms are numbered by a distributed sort;
    a document's vector is built from its own rows; documents without terms have an empty one. The
    vectors are written as plain columns and read again as vectors, which Parquet does not tell apart.
    """
    ids = keys.dense_ids(frequencies, "term", "term_id")
    width = ids.count()
    entry = F.struct("term_id", F.col("tf").cast("double").alias("tf"))
    rows = frequencies.join(ids, "term").groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("e"))
    rows = docs.select(key).join(rows, key, "left")
    nothing = F.array().cast("array<struct<term_id:int,tf:double>>")
    entries = F.coalesce("e", nothing)
    counts = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(max(1, width)).cast("int").alias("size"),
        entries["term_id"].alias("indices"),
        entries["tf"].alias("values"),
    )
    plain = rows.select(key, counts.alias("counts"))
    path = store.new_path(docs.sparkSession, "count-vectors")
    plain.write.parquet(path)
    schema = T.StructType([docs.schema[key], T.StructField("counts", VectorUDT())])
    return Counted(docs.sparkSession.read.schema(schema).parquet(path), ids, max(1, width))


def vocabulary_table(spark: SparkSession, vocabulary: Sequence[str]) -> DataFrame:
    """``(term_id, term)`` from a fitted vocabulary, which the model itself keeps on the driver."""
    ids = pa.array(range(len(vocabulary)), pa.int32())
    return spark.createDataFrame(
        pa.table({"term_id": ids, "term": pa.array(vocabulary, pa.string())})
    )
