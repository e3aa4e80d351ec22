"""Best-fit packing of documents into token sequences of a fixed capacity, over the whole table.

Lengths are whole numbers up to the capacity, so the corpus is a histogram with at most
``capacity`` counts however many documents there are. Spark counts it, the bin-completion search
runs on these counts alone, and its patterns come back as ranges of ranks: the r-th piece of some
length goes to the sequence and place that some range of ranks of that length names. Ranks are
gapless inside (length, scan task), so a length that a third of all pieces share is no hot group.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrec.llm.bin_completion import Effort, pack
from cohortrec.llm.ranks import gapless_rank
from cohortrec.llm.tokens import END_ID, BatchEncoder, byte_slices, encoding
from cohortrec.plans.materialize import materialize

CAPACITY = 4096
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``, with ``ids`` (little-endian unsigned 32-bit) on request.

    Only documents longer than the capacity are cut. NULL and empty texts have their end id only. Repeated rows are cut
    each on its own, a NULL id stays, an empty table gives no rows, other columns are not read.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoding(tokenizer, end_id) as encoder:
            yield from cut(batches, encoder)

    def cut(batches: Iterator[pa.RecordBatch], encoder: BatchEncoder) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in byte_slices(batch, "text"):
                ids, begins = encoder.encode(rows["text"])
                n = np.diff(begins)
                per_doc = -(-n // capacity)
                row = np.repeat(np.arange(len(n)), per_doc)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
                start = piece * capacity
                length = np.minimum(n[row] - start, capacity)
                first = begins[row] + start
                view = memoryview(ids).cast("B")
                crc = [zlib.crc32(view[a:b]) for a, b in zip((first * 4).tolist(), ((first + length) * 4).tolist())]
                columns = [
                    rows["doc_id"].take(pa.array(row)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                if with_ids:  # pieces lie one behind the other in the ids
                    offsets = pa.py_buffer((np.append(first, len(ids)) * 4).astype("<i4"))
                    columns.append(pa.Array.from_buffers(pa.binary(), len(row), [None, offsets, pa.py_buffer(ids)]))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(pieces, PIECES + ", ids binary" * with_ids)


RANK_BUCKETS = 64


def pack_pieces(
    pieces: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece"), effort: Effort = Effort()
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table with a ``length`` of 1 to ``capacity`` per row.

    Sequences are numbered from 0; places in a sequence follow each other without gaps, longest
    piece first. ``order`` only decides which of equally long pieces comes first. All columns of ``pieces`` come back
    as they are, but for columns named like the two new ones, which are refused. Repeated rows are packed each on its
    own; an empty table gives no rows.
    """
    if clash := {"sequence_id", "offset"} & set(pieces.columns):
        raise ValueError(f"rename {', '.join(sorted(clash))} first")
    written = materialize(pieces.withColumn("_part", F.spark_partition_id()), "pieces")
    # At most ``capacity`` rows.
    counts = {r["length"]: r["n"] for r in written.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # The ranks of a length are cut into buckets, so that a piece of a frequent length meets few of its ranges.
    width = {length: -(-n // RANK_BUCKETS) for length, n in counts.items()}
    ranges, first_sequence, used = [], 0, dict.fromkeys(counts, 0)
    for pattern, copies in pack(counts, capacity, effort):
        offset = 0
        for length in pattern:
            low, high = used[length], used[length] + copies
            for bucket in range(low // width[length], (high - 1) // width[length] + 1):
                ranges.append((length, bucket, low, high, first_sequence - low, offset))
            used[length] = high
            offset += length
        first_sequence += copies
    spark = pieces.sparkSession
    places = spark.createDataFrame(ranges, "_of long, _in long, _low long, _high long, _shift long, offset long")
    widths = spark.createDataFrame(list(width.items()), "_length long, _width long")
    ranked = gapless_rank(written, ["length"], "_part", order, "_rank")
    # Both sides are bounded by the capacity and the buckets: ranges are as many as the different patterns hold items.
    ranked = ranked.join(F.broadcast(widths), F.col("length") == F.col("_length"))
    inside = (F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_high"))
    same = (F.col("length") == F.col("_of")) & (F.expr("_rank div _width") == F.col("_in"))
    return ranked.join(F.broadcast(places), same & inside).select(
        *pieces.columns, (F.col("_rank") + F.col("_shift")).alias("sequence_id"), "offset"
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, effort: Effort = Effort(), **columns
) -> DataFrame:
    """One row per piece: ``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``.

    An empty table gives no rows. Repeated rows are packed as often as they occur, each on its own.
    """
    return pack_pieces(cut_pieces(docs, tokenizer, capacity, **columns), capacity, effort=effort)
