"""Token sequences as length-delimited binary records with an offset index.

A data set is a folder with two parts. ``records`` holds shard files ``part-NNNNN-…``, in
ascending document order within a shard and from shard to shard. ``index`` is a Parquet table
with one row per record: shard, record (number in its shard), doc_id, offset and length (bytes
of the whole record in its file), n_tokens, start (ids of all documents before it).

A record, all numbers little-endian::

    u64   length of the payload
    u32   masked CRC-32 of those 8 bytes
    payload: u8 width of an id (2 or 4), u8 1 if there is a doc_id, i64 doc_id, ids
    u32   masked CRC-32 of the payload
    0x0A

A checksum c is stored as ``rotate_right(c, 15) + 0xa282ead8``, so that a checksum of data
that holds checksums stays sound. Ids take two bytes each where all of a record fit. The last
byte lets Spark's own text writer make the files: they reach any file system Spark knows,
and a task that is lost or run twice leaves one whole file.

Shards are ranges of document id, and within an id of a hash of the text, so that rows of one id may
lie in many. The shuffle makes at most ``MOST_RANGES`` of them; the writer cuts each into files of
about ``SHARD_BYTES`` of text, by the mean size of a row, so that a file is small enough to read as
one value at any size of the input. A shard's number is that of its range and of its file there.

NULL text counts as empty and gives a record with the end id alone. NULL ids come first and
stay NULL. Rows with the same id are in order of a hash of their text; each is a record of its own.
An empty table gives no records. Other columns of the input are not looked at.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyloom.llm import common
from tallyloom.llm.tokens import word_tokens

SHARD_BYTES = 16_000_000
MOST_RANGES = 50_000
FILES = 1 << 20
BLOCK_IDS = 1_000_000
HEAD = struct.Struct("<QI")
BODY = struct.Struct("<BBq")
TAIL = struct.Struct("<IB")
EXTRA = HEAD.size + TAIL.size
FIELDS = "shard long, record long, doc_id long, offset long, length long, before long, n_tokens long"


def masked(data) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    """A record without its last byte, which the text writer adds."""
    width = 2 if len(ids) == 0 or int(ids.max()) < 1 << 16 else 4
    payload = BODY.pack(width, doc_id is not None, doc_id or 0) + ids.astype(f"<u{width}").tobytes()
    size = struct.pack("<Q", len(payload))
    return size + struct.pack("<I", masked(size)) + payload + struct.pack("<I", masked(payload))


def parse(data: memoryview, offset: int) -> tuple[int | None, np.ndarray, int]:
    """doc_id, ids and byte length of the record at ``offset``; ValueError if it is damaged."""
    if len(data) < offset + HEAD.size:
        raise ValueError(f"record at {offset} is cut off")
    size, check = HEAD.unpack_from(data, offset)
    if masked(data[offset : offset + 8]) != check:
        raise ValueError(f"damaged length at {offset}")
    first, last = offset + HEAD.size, offset + HEAD.size + size
    if len(data) < last + TAIL.size:
        raise ValueError(f"record at {offset} is cut off")
    if (masked(data[first:last]), 10) != TAIL.unpack_from(data, last):
        raise ValueError(f"damaged payload at {offset}")
    width, named, doc_id = BODY.unpack_from(data, first)
    ids = np.frombuffer(data[first + BODY.size : last], f"<u{width}")
    return (doc_id if named else None), ids, size + EXTRA


def write(docs: DataFrame, path: str, vocabulary: str, end: int, shard_bytes: int = SHARD_BYTES) -> None:
    """Tokenise ``docs`` and write records and index below ``path``."""
    rows = common.take(docs, "doc_id", "text")
    total, count = rows.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    shards = max(1, -(-(total or 0) // shard_bytes))
    each = max(1, -(-count // shards))
    # The last key tells rows apart that are alike in all that is written.
    order = ["doc_id", "_hash", "_row"]
    rows = rows.withColumns({"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    ordered = rows.repartitionByRange(min(shards, MOST_RANGES), *order).sortWithinPartitions(*order)
    ordered = ordered.select("doc_id", "text")

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_tokens(vocabulary)
        for batch in batches:
            made, size = [], 0
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1))):
                made.append(frame(doc_id, np.append(ids, np.uint32(end))))
                size += len(ids)
                if size > BLOCK_IDS:
                    yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["value"])
                    made, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["value"])

    made = ordered.mapInArrow(frames, "value binary")
    # Twice the mean: a range that is a little longer than others stays one file.
    written = made.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 2 * each)
    written.text(f"{path}/records")
    _write_index(docs.sparkSession, path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    name = F.element_at(F.split("path", "/"), -1)
    number = [F.regexp_extract(name, r"^part-(\d+)-.*-c(\d+)", i).cast("long") for i in (1, 2)]
    shard = number[0] * FILES + number[1]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/records")
    return files.select(shard.alias("shard"), "content")


def _write_index(spark: SparkSession, path: str) -> None:
    found = _scan(_files(spark, path), with_ids=False)
    totals = found.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    rows = found.join(bases, "shard").withColumn("start", F.col("base") + F.col("before"))
    rows.select("shard", "record", "doc_id", "offset", "length", "n_tokens", "start").write.parquet(
        f"{path}/index"
    )


def _batch(rows: list[tuple], ids: list[np.ndarray] | None) -> pa.RecordBatch:
    names = [f.split()[0] for f in FIELDS.split(", ")]
    kinds = [pa.int64()] * len(names)
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    if ids is not None:
        columns.append(pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names)


def _scan(files: DataFrame, with_ids: bool) -> DataFrame:
    """All records of the given files, every checksum compared."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data, offset, before, number = memoryview(content.as_buffer()), 0, 0, 0
                rows, ids, size = [], [], 0
                while offset < len(data):
                    doc_id, found, length = parse(data, offset)
                    rows.append((shard, number, doc_id, offset, length, before, len(found)))
                    if with_ids:
                        ids.append(found)
                    offset, before, number = offset + length, before + len(found), number + 1
                    size += len(found)
                    if size > BLOCK_IDS:
                        yield _batch(rows, ids if with_ids else None)
                        rows, ids, size = [], [], 0
                if rows:
                    yield _batch(rows, ids if with_ids else None)

    return files.mapInArrow(records, FIELDS + (", ids binary" if with_ids else ""))


def index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every record, checked: shard, record, doc_id, offset, length, before, n_tokens, ids.

    ``before`` counts the ids ahead of the record in its shard; ``ids`` holds them as
    little-endian unsigned 32-bit numbers.
    """
    return _scan(_files(spark, path), with_ids=True)


def fetch(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The records that ``wanted`` (shard, record, position) names: position, doc_id, ids.

    Each is found by its offset in the index, in any order and as often as it is named.
    """
    places = wanted.select("shard", "record", "position").join(index(spark, path), ["shard", "record"])
    by_file = places.groupBy("shard").agg(F.collect_list(F.struct("position", "offset")).alias("places"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, places in zip(batch.column(1), batch.column(2).to_pylist()):
                data = memoryview(content.as_buffer())
                for place in places:
                    doc_id, ids, _ = parse(data, place["offset"])
                    yield pa.RecordBatch.from_pydict(
                        {
                            "position": pa.array([place["position"]], pa.int64()),
                            "doc_id": pa.array([doc_id], pa.int64()),
                            "ids": pa.array([ids.astype("<u4").tobytes()], pa.binary()),
                        }
                    )

    joined = _files(spark, path).join(by_file, "shard").select("shard", "content", "places")
    return joined.mapInArrow(cut, "position long, doc_id long, ids binary")


def shuffled(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """All records in a repeatable random order: position, doc_id, ids, sorted by position."""
    key = F.xxhash64(F.lit(seed), "shard", "record")
    order = index(spark, path).select("shard", "record", key.alias("position"))
    return fetch(spark, path, order).orderBy("position", "doc_id")
