"""Token ids of a whole table in ascending id order, as files of packed segments.

Texts are range-partitioned by document id, sorted, encoded and packed in one pass. Executors can
write shared storage only through Spark, so a file is a Parquet file whose rows are segments of
about ``SEGMENT_IDS`` ids: ``part`` (range partition), ``segment``, ``part_start`` (ids of the
part before it), ``n_ids``, ``doc_ids`` and ``doc_lengths`` (packed int64 and u32 arrays) and
``data`` (``pfor`` blocks) and ``ids_crc32``, the checksum of the ids before they were packed, which is
compared when the segment is read. Global positions need one total per part, read from the ``n_ids``
column alone.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortrec.llm import pfor
from cohortrec.llm.tokens import END_ID, byte_slices, encoding

SEGMENT_IDS = 1 << 20
SEGMENTS = (
    "part int, segment long, part_start long, n_ids long, ids_crc32 long, doc_ids binary, doc_lengths binary, data binary"
)
NO_ID = np.iinfo(np.int64).min  # how a NULL id is stored


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = END_ID,
    parts: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every whole text and write the files below ``path``.

    NULL text is empty and leaves only its end id. NULL ids come first. Rows of one id keep their
    own entries, side by side in the order of a hash of their text; equal ones may lie in several parts, so
    that a row repeated very often is no single task. An empty table writes no segment.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = segment = position = held = 0
        ids, doc_ids, lengths = [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal segment, position, held
            flat = np.ascontiguousarray(np.concatenate(ids), dtype="<u4")
            row = {
                "part": [part],
                "segment": [segment],
                "part_start": [position],
                "n_ids": [held],
                "ids_crc32": [zlib.crc32(flat)],
                "doc_ids": [np.concatenate(doc_ids).astype("<i8").tobytes()],
                "doc_lengths": [np.concatenate(lengths).astype("<u4").tobytes()],
                "data": [pfor.encode(flat)],
            }
            types = [pa.int32(), *[pa.int64()] * 4, *[pa.binary()] * 3]
            segment, position, held = segment + 1, position + held, 0
            for pending in (ids, doc_ids, lengths):
                pending.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), types)], list(row))

        with encoding(tokenizer, end_id) as encoder:
            for batch in batches:
                for rows in byte_slices(batch, "text"):
                    part = rows["part"][0].as_py()  # a task holds one part
                    found, starts = encoder.encode(rows["text"])
                    ids.append(found)
                    # A copy, as the segment outlives the batch.
                    doc_ids.append(np.array(rows["doc_id"].fill_null(NO_ID).to_numpy(zero_copy_only=False)))
                    lengths.append(np.diff(starts))
                    held += len(found)
                    if held >= SEGMENT_IDS:
                        yield flush()
            if held:
                yield flush()

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("tie"),
        F.monotonically_increasing_id().alias("nth"),
    )
    # The last one only tells equal rows apart.
    order = [F.asc_nulls_first("doc_id"), F.asc("tie"), F.asc("nth")]
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    tagged = ordered.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    tagged.mapInArrow(segments, SEGMENTS).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, ids)``: position of the document's first id in the whole corpus and its
    ids as little-endian unsigned 32-bit integers."""
    table = spark.read.schema(SEGMENTS).parquet(path)
    totals = table.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # One row per written part, hence the broadcast.
    base = (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base")
    placed = table.join(F.broadcast(totals.select("part", base)), "part").select(
        (F.col("base") + F.col("part_start")).alias("start"), "part", "segment", "ids_crc32", "doc_ids", "doc_lengths", "data"
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                doc_ids = np.frombuffer(row["doc_ids"], dtype="<i8")
                ends = np.cumsum(np.frombuffer(row["doc_lengths"], dtype="<u4").astype(np.int64))
                offsets = pa.py_buffer((np.concatenate([[0], ends]) * 4).astype("<i4"))
                ids = np.ascontiguousarray(pfor.decode(row["data"]))
                if len(ids) != ends[-1] or zlib.crc32(ids) != row["ids_crc32"]:
                    raise ValueError(f"the ids of part {row['part']}, segment {row['segment']} are damaged")
                data = pa.py_buffer(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, mask=doc_ids == NO_ID),
                        pa.array(row["start"] + np.concatenate([[0], ends[:-1]])),
                        pa.Array.from_buffers(pa.binary(), len(doc_ids), [None, offsets, data]),
                    ],
                    ["doc_id", "start", "ids"],
                )

    return placed.mapInArrow(documents, "doc_id long, start long, ids binary")
