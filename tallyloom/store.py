"""Tables and models that a workflow reuses, written once to the shared folder.

A written table does three jobs on a cluster. It cuts lineage, so a lost executor costs a
re-read and not a recomputation. Its file size is known to the planner, so Spark broadcasts
it only when it is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise plans a
sort-merge join that AQE can split on hot keys (it cannot split below an aggregate). And it
is evaluated once, so every consumer sees the same rows.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, which all executors share.

    Where none is set, a local session (as in tests) gets a temporary one; anything else is an
    error. MLlib's iterative learners cut their lineage in the same folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tallyloom-")
        context.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    folder = shared_folder(spark)
    app = spark.sparkContext.applicationId
    return f"{folder.rstrip('/')}/tallyloom/{app}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return the table read back."""
    path = new_path(df.sparkSession, name)
    with shuffles_deleted(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_deleted(spark: SparkSession):
    """Shuffle files of what is run here go when it ends. Else they stay until the driver collects its
    garbage, and a workflow of many written tables holds the shuffles of them all."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def discard(table: DataFrame) -> None:
    """Delete the files of a table that ``materialise`` wrote and nothing reads any more."""
    context = table.sparkSession.sparkContext
    own = f"/tallyloom/{context.applicationId}/"
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        if own not in folder:
            raise ValueError(f"not a table of this application: {folder}")
        path = context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(folder))
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def by_size(df: DataFrame, task_bytes: int) -> DataFrame:
    """``df``, a written table, in no more tasks than its size asks for.

    Iterative learners send their weights to every task and back in each step, so a table that one
    task could hold should not be spread over many. Nothing changes where the table is large.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.coalesce(max(1, -(-size // task_bytes)))


def stamp(spark: SparkSession, paths: list[str]) -> tuple:
    """Number, bytes and latest change of the files below each path: it differs after a rewrite."""
    out = []
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not system.exists(place):
            out.append((path, 0, 0, 0))
            continue
        files, number, size, latest = system.listFiles(place, True), 0, 0, 0
        while files.hasNext():
            status = files.next()
            number, size = number + 1, size + status.getLen()
            latest = max(latest, status.getModificationTime())
        out.append((path, number, size, latest))
    return tuple(out)


def release(spark: SparkSession) -> None:
    """Delete every table this application wrote through ``materialise``."""
    folder = shared_folder(spark)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(
        f"{folder.rstrip('/')}/tallyloom/{spark.sparkContext.applicationId}"
    )
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
