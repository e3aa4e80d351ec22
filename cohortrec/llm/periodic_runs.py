"""Periodic run detection: period octaves, overlapping tiles, boundary Z-functions, stitched fragments.

A run is a maximal stretch of words with smallest period ``q`` (words ``q`` apart are equal) of at least
``max(MIN_LENGTH, MIN_POWER * q)`` words. Periods are cut into octaves ``2**k <= q < 2**(k+1)``. In an
octave, boundaries stand every ``2 * 2**k`` words. A run matches itself, shifted by ``q``, over ``3 * q``
words or more, so at least one boundary ``b`` has ``b - q`` inside this match, and neighbouring boundaries
meet. Two Z-functions of the words around ``b`` give, for every ``q`` of the octave, how far the match reaches
to the right and to the left of ``b - q``. They see four octave widths to the left and two to the right, so a
longer match comes in fragments, one per boundary, that touch.

1. Documents are exploded into tiles per octave. All octaves up to a quarter of ``TILE_WORDS`` share one tile of that
   many words with the overlap of the widest octave; wider octaves have wider tiles of their own. Tiles of a
   document that needs more than one are rows of their own, spread over the cluster; a document with one
   tile is solved where it was read.
2. Every tile is solved alone and returns its match fragments, joined where they touch inside the tile.
3. Fragments are shuffled by document and period, and stitched where they touch.

Before the Z-functions run, a boundary is tried against all shifts of its octave at once by comparing
hashes of a few words on either side, which any match that is long enough must pass.
"""

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortrec.llm.tokens import byte_slices
from cohortrec.plans.materialize import materialize

MIN_LENGTH, MIN_POWER = 6, 4
TILE_WORDS = 1 << 16
SLICE_BYTES = 2 << 20
WORD = r"[^\x20\x09-\x0D]+"
MIX = np.uint64(0x9E3779B97F4A7C15)

Fragment = tuple[int, int, int]  # period, and the match as a half-open range of word numbers


def z_function(s: list[int]) -> list[int]:
    """For every place how many items from it on equal the beginning of ``s``."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[i + k] == s[k]:
            k += 1
        z[i] = k
        left, right = i, i + k
    if n:
        z[0] = n
    return z


def prime_factors(n: int) -> list[int]:
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return found + [n] if n > 1 else found


def boundary_matches(words: list[int], begin: int, end: int, b: int, width: int, shifts: list[int]) -> list[Fragment]:
    """Matches at boundary ``b`` for the shifts that are smallest periods, seen through the boundary's window.

    ``words`` holds the document from word ``begin`` to ``end``, or the part of it that a tile holds.
    """
    low, high = max(begin, b - 4 * width), min(end, b + 2 * width)
    first = max(low, b - 2 * width + 1)
    right = z_function([*words[b - begin : high - begin], -1, *words[first - begin : high - begin]])
    left = z_function(words[low - begin : b - begin][::-1])
    offset = high - b + 1 - first
    found = []
    for q in shifts:
        start = b - q
        reach = right[start + offset]
        back = left[q] if q < len(left) else 0
        if not reach and not back:
            continue
        # The block before b is a power of a shorter one: the whole match has a shorter period.
        if any(left[q // r] >= q - q // r for r in prime_factors(q)):
            continue
        found.append((q, start - back, start + reach))
    return found


def join_touching(fragments: list[Fragment]) -> list[Fragment]:
    joined: list[Fragment] = []
    for q, low, high in sorted(fragments):
        if joined and joined[-1][0] == q and low <= joined[-1][2]:
            joined[-1] = (q, joined[-1][1], max(joined[-1][2], high))
        else:
            joined.append((q, low, high))
    return joined


def long_enough(q: int, matched: int) -> bool:
    return matched + q >= max(MIN_LENGTH, MIN_POWER * q)


def grams(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each place on; unequal hashes mean unequal words."""
    out = codes.astype(np.uint64) * MIX
    mixed = out.copy()
    for step in range(1, size):
        mixed[:-step] = (mixed[:-step] ^ (mixed[:-step] >> np.uint64(29))) * MIX + out[step:]
    return mixed


def candidates(codes: np.ndarray, tiles: np.ndarray, octave: int, hashes: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Boundaries of one octave and the shifts that may match there, over all ``tiles`` of a batch.

    A tile is ``(first place in codes, words before it in the document, words, core begin, core end)``;
    its boundaries are the multiples of twice the octave's width inside the core. Returns places in ``codes``
    and shifts, by place.
    """
    width = 1 << octave
    place, before, words, core, core_end = tiles.T
    first = -(-np.maximum(core, 1) // (2 * width)) * (2 * width)
    count = np.maximum(-(-(np.minimum(core_end, before + words) - first) // (2 * width)), 0)
    total = int(count.sum())
    nth = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(place - before + first, count) + nth * 2 * width
    start = np.repeat(place, count)
    gram = hashes.setdefault(size := 3 if octave < 2 else 6, grams(codes, size) if size not in hashes else None)
    found_at, found_shift = [], []
    rows = max(1, (1 << 20) // width)
    shifts = np.arange(width, 2 * width)
    for begin in range(0, total, rows):
        b = at[begin : begin + rows, None]
        t = b - shifts
        inside = t >= start[begin : begin + rows, None]
        ahead = gram[np.maximum(t, 0)] == gram[b]
        behind = gram[np.maximum(t - size + 1, 0)] == gram[np.maximum(b - size + 1, 0)]
        row, column = np.nonzero((ahead | behind) & inside)
        found_at.append(b[row, 0])
        found_shift.append(shifts[column])
    empty = [np.empty(0, dtype=np.int64)]
    return np.concatenate(found_at or empty), np.concatenate(found_shift or empty)


def solve(codes: np.ndarray, tiles: np.ndarray, lengths: np.ndarray, first: int, last: int) -> list[list[Fragment]]:
    """Fragments of every tile for the octaves ``first`` to ``last``.

    ``lengths`` are the word counts of the documents. A match that ends inside its tile and is too short
    for a run is left out.
    """
    found: list[list[Fragment]] = [[] for _ in tiles]
    hashes: dict[int, np.ndarray] = {}
    for octave in range(first, last + 1):
        some = np.flatnonzero(lengths // MIN_POWER >= 1 << octave)
        if not len(some):
            break
        at, shift = candidates(codes, tiles[some], octave, hashes)
        if not len(at):
            continue
        owner = some[np.searchsorted(tiles[some, 0], at, side="right") - 1]
        edge = np.flatnonzero(np.diff(at, prepend=-1, append=-1))
        held, words = -1, []
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            tile = int(owner[a])
            place, before, count, _, _ = tiles[tile].tolist()
            if tile != held:
                held, words = tile, codes[place : place + count].tolist()
            boundary = int(at[a]) - place + before
            found[tile] += boundary_matches(words, before, before + count, boundary, 1 << octave, shift[a:b].tolist())
    out = []
    for fragments, (_, _, _, core, core_end), length in zip(found, tiles.tolist(), lengths.tolist()):
        # A match at an edge of the core may go on at the boundaries of the next tile.
        out.append([
            (q, low, high)
            for q, low, high in join_touching(fragments)
            if long_enough(q, high - low) or (core and low <= core) or (core_end < length and high + q >= core_end)
        ])
    return out


def cut_tiles(n: int, core: int = TILE_WORDS) -> list[tuple[int, int, int, int, int, int]]:
    """``(first octave, last octave, begin, end, core begin, core end)`` of all tiles of a document of ``n`` words."""
    top = (n // MIN_POWER).bit_length() - 1
    shared = max((core // MIN_POWER).bit_length() - 1, 0)
    groups = [(0, min(shared, top), core)] + [(k, k, MIN_POWER << k) for k in range(shared + 1, top + 1)]
    tiles = []
    for first, last, size in groups:
        if last < first:
            continue
        left, right = 4 << last, 2 << last
        for begin in range(0, n, size):
            end = min(n, begin + size)
            tiles.append((first, last, max(0, begin - left), min(n, end + right), begin, end))
    return tiles


SCANNED = (
    "row long, doc_id long, n long, plain_sha256 string, words string, "
    "fragments array<struct<period:long,low:long,high:long>>, first int, last int, begin long, core long, core_end long, codes binary"
)
FRAGMENTS = pa.list_(pa.struct([("period", pa.int64()), ("low", pa.int64()), ("high", pa.int64())]))
SCANNED_TYPES = {
    "row": pa.int64(), "doc_id": pa.int64(), "n": pa.int64(), "plain_sha256": pa.string(), "words": pa.string(),
    "fragments": FRAGMENTS, "first": pa.int32(), "last": pa.int32(), "begin": pa.int64(), "core": pa.int64(),
    "core_end": pa.int64(), "codes": pa.binary(),
}


def _batch(columns: dict) -> pa.RecordBatch:
    size = len(columns["row"])
    arrays = []
    for name, kind in SCANNED_TYPES.items():
        values = columns.get(name)
        arrays.append(values if isinstance(values, pa.Array) else pa.nulls(size, kind) if values is None else pa.array(values, kind))
    return pa.RecordBatch.from_arrays(arrays, list(SCANNED_TYPES))


def _structs(fragments: list[Fragment]) -> list[dict]:
    return [{"period": q, "low": low, "high": high} for q, low, high in fragments]


def _scan(batches: Iterator[pa.RecordBatch], core: int) -> Iterator[pa.RecordBatch]:
    """One row per document, and one row per tile of documents that need several."""
    for batch in batches:
        for rows in byte_slices(batch, "text", SLICE_BYTES):
            split = [(t or "").encode().split() for t in rows["text"].to_pylist()]
            joined = [b" ".join(words) for words in split]
            lengths = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
            flat = pa.array([w for words in split for w in words], pa.binary())
            del split
            codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            del flat
            starts = np.cumsum(lengths) - lengths
            small = np.flatnonzero(lengths <= core)
            zero = np.zeros(len(small), dtype=np.int64)
            tiles = np.stack([starts[small], zero, lengths[small], zero, lengths[small]], axis=1)
            top = (int(lengths[small].max(initial=0)) // MIN_POWER).bit_length() - 1
            fragments: list[list[Fragment] | None] = [None] * len(lengths)
            for row, found in zip(small.tolist(), solve(codes, tiles, lengths[small], 0, top)):
                fragments[row] = found
            yield _batch({
                "row": rows["row"],
                "doc_id": rows["doc_id"],
                "n": lengths,
                "plain_sha256": [hashlib.sha256(text).hexdigest() for text in joined],
                # The words are needed again only where something may be dropped.
                "words": [None if f == [] else text.decode() for text, f in zip(joined, fragments)],
                "fragments": [None if f is None else _structs(f) for f in fragments],
            })
            for row in np.flatnonzero(lengths > core).tolist():
                one = codes[starts[row] : starts[row] + lengths[row]]
                for first, last, begin, end, core_begin, core_end in cut_tiles(int(lengths[row]), core):
                    yield _batch({
                        "row": rows["row"].slice(row, 1), "n": lengths[row : row + 1], "first": [first], "last": [last],
                        "begin": [begin], "core": [core_begin], "core_end": [core_end],
                        "codes": [one[begin:end].astype("<i4").tobytes()],
                    })


def _solve_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row, n, first, last, begin, core, core_end, data = (
                batch[c][i].as_py() for c in ("row", "n", "first", "last", "begin", "core", "core_end", "codes")
            )
            codes = np.frombuffer(data, dtype="<i4").astype(np.int64)
            tile = np.array([[0, begin, len(codes), core, core_end]])
            found = solve(codes, tile, np.array([n]), first, last)[0]
            columns = zip(*found) if found else ((), (), ())
            arrays = [pa.array(np.array(c, dtype=np.int64)) for c in columns]
            yield pa.RecordBatch.from_arrays([pa.array([row] * len(found), pa.int64()), *arrays], ["row", "period", "low", "high"])


def stitch(fragments: DataFrame) -> DataFrame:
    """``(row, start, length, period)`` of all runs, from match fragments ``(row, period, low, high)``.

    Fragments of one document and period that touch are one match. A match of ``m`` words is a run of ``m + period``.
    """
    same = Window.partitionBy("row", "period").orderBy("low", "high")
    before = F.max("high").over(same.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(before.isNull() | (F.col("low") > before), 1).otherwise(0)
    match = fragments.withColumn("_begins", begins).withColumn("_match", F.sum("_begins").over(same))
    match = match.groupBy("row", "period", "_match").agg(F.min("low").alias("start"), F.max("high").alias("_high"))
    runs = match.withColumn("length", F.col("_high") - F.col("start") + F.col("period"))
    return runs.where(F.col("length") >= F.greatest(F.lit(MIN_LENGTH), MIN_POWER * F.col("period"))).select(
        "row", "start", "length", "period"
    )


def find_runs(
    docs: DataFrame, tile_words: int = TILE_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(row, doc_id, n, plain_sha256, words, runs)``, one row per input row.

    ``words`` are the words joined by one space, given only where there may be runs; ``plain_sha256`` is their
    SHA-256 in hexadecimal digits. ``runs`` is the list of ``(start, period, length)`` by start and period, empty where
    there is none. NULL and empty texts have no words. Repeated rows, and rows without an id, are documents of
    their own, told apart by ``row``; an empty table gives no rows; other columns are not read.
    ``tile_words`` changes how the work is cut, never the result.
    """
    if tile_words < 2 * MIN_LENGTH:
        raise ValueError(f"a tile needs at least {2 * MIN_LENGTH} words")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
    )
    scanned = materialize(rows.mapInArrow(lambda batches: _scan(batches, tile_words), SCANNED), "scanned")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A tile is heavy whatever its bytes, so the rows are dealt out in turn.
    tiles = scanned.where("codes is not null").select("row", "n", "first", "last", "begin", "core", "core_end", "codes")
    far = tiles.repartition(parts).mapInArrow(_solve_tiles, "row long, period long, low long, high long")
    near = scanned.where("size(fragments) > 0").select("row", F.inline("fragments"))
    runs = stitch(near.select("row", "period", "low", "high").union(far))
    listed = runs.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    documents = scanned.where("codes is null").select("row", "doc_id", "n", "plain_sha256", "words")
    none = F.array().cast("array<struct<start:long,period:long,length:long>>")
    # Texts without any fragment do not take part in the join.
    quiet = documents.where("words is null").withColumn("runs", none)
    loud = documents.where("words is not null").join(listed.withColumnRenamed("row", "_row"), F.col("row") == F.col("_row"), "left")
    return quiet.unionByName(loud.drop("_row").withColumn("runs", F.coalesce("runs", none)))


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run ``(start, period, length)`` holds behind its first period."""
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, period, length in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run with the greatest exact length over period; ties go to the smallest start, then period."""
    return max(runs, key=lambda r: (Fraction(r[2], r[1]), -r[0], -r[1]))


def summarise_runs(found: DataFrame) -> DataFrame:
    """``(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256)`` of ``find_runs``.

    The first run columns describe the strongest run, and are NULL without one. ``runs_sha256`` is over lines
    ``start,length,period``; ``collapsed_sha256`` is over the text without the words that only repeat.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, plain, words, runs in zip(*(batch[c] for c in ("doc_id", "plain_sha256", "words", "runs"))):
                listed = [(r["start"].as_py(), r["period"].as_py(), r["length"].as_py()) for r in runs]
                lines = "".join(f"{s},{length},{p}\n" for s, p, length in listed)
                best, sha = (None,) * 4, plain.as_py()
                if listed:
                    s, p, length = strongest(listed)
                    best = (s, length, p, 1000 * length // p)
                    sha = hashlib.sha256(b" ".join(kept_words(words.as_py().encode().split(), listed))).hexdigest()
                out.append((doc_id.as_py(), len(listed), *best, hashlib.sha256(lines.encode()).hexdigest(), sha))
            types = [*[pa.int64()] * 6, *[pa.string()] * 2]
            columns = zip(*out) if out else [[]] * len(types)
            names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    schema = (
        "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs_sha256 string, collapsed_sha256 string"
    )
    return found.select("doc_id", "plain_sha256", "words", "runs").mapInArrow(run, schema)


def collapse_runs(docs: DataFrame, tile_words: int = TILE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text, dropped)``: words that only repeat a run's first period are taken out, ``dropped`` counts them.

    Words are joined by one space in texts that lose words; all other texts come back unchanged, NULL as empty.
    """
    kept = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, dropped = [], []
            for words, runs in zip(batch["words"], batch["runs"]):
                listed = [(r["start"].as_py(), r["period"].as_py(), r["length"].as_py()) for r in runs]
                before = words.as_py().encode().split()
                after = kept_words(before, listed)
                texts.append(b" ".join(after).decode())
                dropped.append(len(before) - len(after))
            columns = [batch["row"], pa.array(texts, pa.string()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "text", "dropped"])

    numbered = materialize(kept.withColumn("row_", F.monotonically_increasing_id()), "numbered")
    found = find_runs(numbered.select(F.col("row_").alias("doc_id"), "text"), tile_words).where("size(runs) > 0")
    changed = found.select(F.col("doc_id").alias("row"), "words", "runs").mapInArrow(run, "row long, text string, dropped long")
    changed = changed.withColumnsRenamed({"text": "shorter"})
    return numbered.join(changed, F.col("row_") == F.col("row"), "left").select(
        "doc_id", F.coalesce("shorter", "text").alias("text"), F.coalesce("dropped", F.lit(0).cast("long")).alias("dropped")
    )


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` in which every tenth document, by the checksum of its id, repeats itself.

    With ``h = crc32(id)``, ``g = h div 10`` and ``n`` words, the words from ``a = g % n`` on become the first
    ``p = 1 + (n - a) div (3 + g % 8)`` of them, again and again. Documents without an id or words stay.
    """
    h = F.crc32(F.encode(F.col(id_col).cast("long").cast("string"), "UTF-8"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), h.alias("h"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    rows = rows.withColumn("words", F.when(F.expr("h % 10 = 0"), words)).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.expr("cast((h div 10) % nullif(n, 0) as int)"))
    rows = rows.withColumn("p", F.expr("cast(1 + (n - a) div (3 + (h div 10) % 8) as int)"))
    tail = F.expr("slice(flatten(array_repeat(slice(words, a + 1, p), cast(ceil((n - a) / p) as int))), 1, n - a)")
    text = F.array_join(F.concat(F.expr("slice(words, 1, a)"), tail), " ")
    return rows.select("doc_id", F.when(F.expr("h % 10 = 0 and n > 0"), text).otherwise(F.col("text")).alias("text"))
