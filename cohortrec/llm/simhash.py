"""SimHash near-dedup with Golay-code fuzzy keys.

A 64-bit fingerprint is cut into three segments, each padded to a 23-bit Golay word. Two
fingerprints within 4 bits fall into one of two cases. Either no segment differs in more than 2
bits: then all three segments share a codeword index, and some triple of indices agrees. Or one
segment differs in 3 or more: then the other two differ in 1 bit at most together, so one is equal and
the other shares an index. Each fingerprint therefore gets some 180 keys, links are found among
fingerprints with an equal key, and every candidate is verified by its bit distance.

Only distinct fingerprints take part. Keys are shuffled and sorted; a task streams over its keys
and holds one block of a key's fingerprints at a time. A key with more than ``BLOCK`` fingerprints is
cut into blocks whose pairs become tasks of their own. Inside a block only spanning links leave.
"""

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrec.llm import golay
from cohortrec.llm.components import connected_components
from cohortrec.llm.exact_dedup import one_row
from cohortrec.llm.tokens import byte_slices, release_memory
from cohortrec.plans.materialize import materialize

SHINGLE = 4
MAX_BITS = 4
SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and bits
BLOCK = 2048
PART = 1 << 16  # shingles of a text that are hashed at once
SHORT_RUN = 8  # equal keys up to which all pairs are compared at once
LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """The hash of every shingle as unsigned 64-bit numbers."""
    words = text.lower().split()  # lower-cases A-Z and splits at the six ASCII white-space characters
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    del words
    ends = np.cumsum(lengths + 1) - 1
    begins, ends = (ends - lengths)[: 1 - size], ends[size - 1 :]
    out = np.empty(len(begins), dtype=np.uint64)
    for first in range(0, len(begins), PART):
        spans = map(slice, begins[first : first + PART].tolist(), ends[first : first + PART].tolist())
        part = map(xxhash.xxh64_intdigest, map(joined.__getitem__, spans), itertools.repeat(SEED))
        out[first : first + PART] = np.fromiter(part, dtype=np.uint64, count=min(PART, len(begins) - first))
    return out


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The fingerprint of each run of ``sizes`` hashes: bits that more than half of them set."""
    out = np.zeros(len(sizes), dtype=np.uint64)
    some = np.flatnonzero(sizes)
    if not len(some):
        return out
    n = sizes[some]
    # Eight counters per 64-bit lane sum; a counter holds 255 hashes, so runs are cut before summing.
    cuts = -(-n // 255)
    first_cut = np.cumsum(cuts) - cuts
    begin = np.cumsum(n) - n
    starts = np.repeat(begin, cuts) + 255 * (np.arange(cuts.sum()) - np.repeat(first_cut, cuts))
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & LANES, starts)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first_cut, axis=0)
        for byte in range(8):
            out[some] |= (2 * counts[:, byte] > n).astype(np.uint64) << np.uint64(8 * byte + bit)
    return out


def fingerprints(
    docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False
) -> DataFrame:
    """``(doc_id, fp)``, and ``text`` if asked for, with the fingerprint as a signed 64-bit number; NULL text counts as empty."""
    kept = ["doc_id", "text"] if with_text else ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in byte_slices(batch, "text"):
                each = [shingle_hashes((t.as_py() or "").encode(), shingle) for t in rows["text"]]
                sizes = np.fromiter(map(len, each), dtype=np.int64, count=len(each))
                found = majority(np.concatenate(each), sizes).view(np.int64)
                yield pa.RecordBatch.from_arrays([*(rows[c] for c in kept), pa.array(found)], [*kept, "fp"])
        release_memory()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, {'text string, ' if with_text else ''}fp long")


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and the place of their fingerprint, such that fingerprints within 4 bits share a key."""
    words, codes, valid = [], [], []
    for first, bits in SEGMENTS:
        word = (fps >> np.uint64(first)) & np.uint64((1 << bits) - 1)
        found, count = golay.keys(word)
        words.append(word)
        codes.append(found.astype(np.uint64))
        valid.append(np.arange(golay.KEYS) < count[:, None])
    bits = np.uint64(golay.MESSAGE)
    triple = (codes[0][:, :, None, None] << (bits + bits)) | (codes[1][:, None, :, None] << bits) | codes[2][:, None, None, :]
    there = valid[0][:, :, None, None] & valid[1][:, None, :, None] & valid[2][:, None, None, :]
    at = [np.nonzero(there)[0]]
    keys = [triple[there]]
    tag = 1
    for equal in range(3):
        for near in range(3):
            if equal != near:
                key = (words[equal][:, None] << bits) | codes[near] | np.uint64(tag << 40)
                keys.append(key[valid[near]])
                at.append(np.nonzero(valid[near])[0])
                tag += 1
    return np.concatenate(keys), np.concatenate(at)


def star_links(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the fingerprints within ``max_bits`` of each other, at most one per fingerprint."""
    left, a, b = fps, [], []
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            near = np.bitwise_count(left ^ front[0]) <= max_bits
            hit = left[near]
            if len(hit):
                a.append(np.repeat(front[:1], len(hit)))
                b.append(hit)
                left = left[~near]
                front = np.concatenate([front, hit])
            front = front[1:]
    empty = [np.empty(0, dtype=np.uint64)]
    return np.concatenate(a or empty), np.concatenate(b or empty)


LINKS = "a long, b long, key long, block int"


def _signed(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.uint64).view(np.int64))


def _rows(a: np.ndarray, b: np.ndarray | None, key: int | None = None, block: int | None = None) -> pa.RecordBatch:
    n = len(a)
    columns = [
        _signed(a),
        pa.nulls(n, pa.int64()) if b is None else _signed(b),
        pa.nulls(n, pa.int64()) if key is None else pa.array(np.full(n, key, dtype=np.int64)),
        pa.nulls(n, pa.int32()) if block is None else pa.array(np.full(n, block, dtype=np.int32)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["a", "b", "key", "block"])


def _link_sorted(batches: Iterator[pa.RecordBatch], max_bits: int, limit: int) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (key, fp): verified links ``(a, b)``, and the blocks ``(a, key, block)`` of long keys."""
    held_key = np.empty(0, dtype=np.int64)
    held = np.empty(0, dtype=np.uint64)
    block = 0

    def linked(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        edge = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1, append=keys[-1] + 1))
        size = np.diff(edge)
        for k in np.flatnonzero(size > SHORT_RUN):
            x, y = star_links(fps[edge[k] : edge[k + 1]], max_bits)
            a.append(x)
            b.append(y)
        short = np.repeat(size <= SHORT_RUN, size)
        keys, fps = keys[short], fps[short]
        for shift in range(1, SHORT_RUN):
            if len(keys) <= shift:
                break
            same = keys[shift:] == keys[:-shift]
            if not same.any():
                break
            at = np.flatnonzero(same)
            at = at[np.bitwise_count(fps[at] ^ fps[at + shift]) <= max_bits]
            a.append(fps[at])
            b.append(fps[at + shift])
        if a:
            pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0)
            if len(pairs):
                yield _rows(pairs[:, 0], pairs[:, 1])

    def close() -> Iterator[pa.RecordBatch]:
        nonlocal block
        if block and len(held):
            yield _rows(held, None, int(held_key[0]), block)
        block = 0
        if len(held) > 1:
            yield from linked(held_key, held)

    for batch in batches:
        keys = batch["key"].to_numpy()
        fps = batch["fp"].to_numpy().view(np.uint64)
        if not len(keys):
            continue
        if len(held_key) and held_key[0] != keys[0]:
            yield from close()
            held_key, held = held_key[:0], held[:0]
        held_key, held = np.concatenate([held_key, keys]), np.concatenate([held, fps])
        last = int(np.searchsorted(held_key, held_key[-1]))
        if last:  # the key of the last row may go on in the next batch
            if block:
                first = int(np.searchsorted(held_key, held_key[0], side="right"))
                rest_key, rest = held_key[first:], held[first:]
                held_key, held = held_key[:first], held[:first]
                yield from close()
                last -= first
                held_key, held = rest_key, rest
            if last:
                yield from linked(held_key[:last], held[:last])
            held_key, held = held_key[last:], held[last:]
        while len(held) > limit:
            part_key, part = held_key[:limit], held[:limit]
            yield _rows(part, None, int(part_key[0]), block)
            yield from linked(part_key, part)
            held_key, held, block = held_key[limit:], held[limit:], block + 1
    yield from close()


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """``(a, b)``: links that connect whatever distinct values of ``fp`` connect within ``max_bits`` bits."""
    if not 0 <= max_bits <= 2 * golay.TOLERANCE:
        raise ValueError("the keys find pairs of up to 4 differing bits")
    spark = fps.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch["fp"].to_numpy().view(np.uint64)
            for begin in range(0, len(values), 1000):
                some = values[begin : begin + 1000]
                keys, at = fuzzy_keys(some)
                yield pa.RecordBatch.from_arrays([_signed(keys), _signed(some[at])], ["key", "fp"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _link_sorted(batches, max_bits, block)

    def tile(table: pa.Table) -> pa.Table:
        x, y = star_links(table["a"].to_numpy().view(np.uint64), max_bits)
        return pa.table([_signed(x), _signed(y)], names=["a", "b"])

    # A repartition of its own, as adaptive execution would merge the small input into few tasks.
    spread = fps.select("fp").repartition(parts, "fp").mapInArrow(keyed, "key long, fp long")
    found = spread.repartition(parts, "key").sortWithinPartitions("key", "fp").mapInArrow(link, LINKS)
    found = materialize(found, "links")
    blocks = found.where("key is not null").select("a", "key", "block")
    most = blocks.groupBy("key").agg(F.max("block").alias("last"))
    others = F.expr("filter(sequence(0, last), other -> other <> block)")
    tiles = blocks.join(most, "key").withColumn("other", F.explode(others))
    tiles = tiles.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    crossed = tiles.groupBy("key", "low", "high").applyInArrow(tile, "a long, b long")
    return found.where("key is null").select("a", "b").union(crossed)


def near_groups(
    docs: DataFrame,
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per input row.

    ``component_id`` is the smallest id reachable over links of at most ``max_bits`` differing bits.
    Texts without words, NULL texts among them, have fingerprint zero and link like any other.
    Rows without an id are linked but name no component, unless all of it has no id. Repeated rows
    get equal results; an empty table gives none; other columns are not read.
    """
    marked, named = _components(docs, shingle, max_bits, id_col, text_col, block)
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _components(
    docs: DataFrame, shingle: int, max_bits: int, id_col: str, text_col: str, block: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, fp)`` of all rows, and ``(fp, component_id, group)`` of their fingerprints, as written tables.

    ``group`` is a fingerprint that names the component whether or not it has an id.
    """
    marked = materialize(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    firsts = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "firsts")
    members = connected_components(fingerprint_links(firsts, max_bits, block))
    linked = materialize(members.join(firsts, F.col("node") == F.col("fp")).select("fp", "component", "first"), "linked")
    least = linked.groupBy("component").agg(F.min("first").alias("least"))
    named = linked.join(least, "component").select(F.col("fp").alias("member"), "component", "least")
    named = firsts.join(named, F.col("fp") == F.col("member"), "left")
    component, group = F.coalesce("least", "first").alias("component_id"), F.coalesce("component", "fp").alias("group")
    return marked, materialize(named.select("fp", component, group), "named")


def drop_near_copies(
    docs: DataFrame,
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
    single: bool = False,
) -> DataFrame:
    """One document of each group stays, the one with the smallest id, with all its columns.

    Rows without an id all stay, and so do repeated rows of the id that stays. Of an id with texts in several groups, the texts
    stay of whose groups it is the smallest id; only such ids are looked at text by text. With ``single`` exactly one row of
    each group stays, the least by id, text and its other columns. NULL and empty texts are like each other. An empty
    table gives no rows.
    """
    if single:
        return _one_of_each(docs, shingle, max_bits, id_col, text_col)
    near = near_groups(docs, shingle, max_bits, id_col, text_col).where("doc_id is not null")
    goes = F.col("doc_id") != F.col("component_id")
    ids = near.groupBy("doc_id").agg(F.max(goes).alias("some"), F.min(goes).alias("all"))
    ids = materialize(ids.where("some").select(F.col("doc_id").alias("_dropped_id"), "all"), "dropped")
    whole, mixed = ids.where("all").drop("all"), materialize(ids.where("not all").drop("all"), "mixed")
    copies = near.where(goes).join(mixed, near["doc_id"] == mixed["_dropped_id"], "left_semi")
    copies = copies.select(F.col("doc_id").alias("_id"), F.col("fingerprint").alias("_fp")).distinct()
    several = docs.join(mixed, docs[id_col] == mixed["_dropped_id"], "left_semi")
    texts = fingerprints(several, shingle, id_col, text_col, with_text=True)
    texts = texts.distinct().join(copies, (F.col("doc_id") == F.col("_id")) & (F.lower(F.lpad(F.hex("fp"), 16, "0")) == F.col("_fp")))
    texts = materialize(texts.select("_id", F.col("text").alias("_text")), "copies")
    rest = docs.join(whole, docs[id_col] == whole["_dropped_id"], "left_anti")
    return rest.join(texts, (rest[id_col] == texts["_id"]) & rest[text_col].eqNullSafe(texts["_text"]), "left_anti")


def _one_of_each(docs: DataFrame, shingle: int, max_bits: int, id_col: str, text_col: str) -> DataFrame:
    marked, named = _components(docs, shingle, max_bits, id_col, text_col)
    placed = marked.join(named, "fp").where("doc_id is not null")
    goes = F.max(F.col("doc_id") != F.col("component_id")).alias("goes")
    ids = placed.groupBy(F.col("doc_id").alias("_id")).agg(F.count("*").alias("rows"), goes)
    # An id of one row is decided by the id. Rows of other ids, and those without one, are looked at one by one.
    # Ids of one row that stays are most by far and not written, so that the joins see how few the others are.
    ids = materialize(ids.where("rows > 1 or goes"), "ids")
    several = materialize(ids.where("rows > 1").select("_id"), "several")
    whole = docs.where(F.col(id_col).isNotNull())
    other = ids.select("_id")
    decided = whole.join(other, whole[id_col] == other["_id"], "left_anti")
    open_rows = whole.join(several, whole[id_col] == several["_id"], "left_semi").unionByName(docs.where(F.col(id_col).isNull()))
    row = "_row"
    while row in docs.columns:
        row += "_"
    open_rows = materialize(open_rows.withColumn(row, F.monotonically_increasing_id()), "open_rows")
    prints = fingerprints(open_rows, shingle, row, text_col).join(named, "fp")
    prints = prints.select(F.col("doc_id").alias("_of"), F.col("component_id").alias("_component"), F.col("group").alias("_group"))
    least = open_rows.join(prints, open_rows[row] == prints["_of"]).where(F.col(id_col).eqNullSafe(F.col("_component")))
    return decided.unionByName(one_row(least, "_group", text_col, docs.columns))
