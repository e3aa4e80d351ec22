"""SentencePiece encoding and decoding by suffix-array matching.

The different words of a batch are written one behind the other, with a separator that no piece
holds. A suffix array over this text, sorted to the depth of the longest piece, gives every
occurrence of a piece as one range, found by binary search for all pieces at once. Each occurrence is an edge
from its begin to its end. Edges are sorted by position and relaxed from left to right.

For a BPE model the best way to a position is not the one with the best sum of scores, but the one
that merging makes. A sequence of pieces is what merging makes exactly when each neighbouring pair stays
apart when merged by itself. So an edge is relaxed if its piece stays apart from the last piece on the
way to its begin, and one edge at each position does. Results equal those of the ``sentencepiece`` library.
"""

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrec.llm.piece_model import SPACE, PieceModel
from cohortrec.llm.tokens import byte_slices

SLICE_BYTES = 2 << 20
REMEMBERED = 200_000  # words whose ids a worker keeps; bounds memory, without effect on results
LONG = 400  # characters from which a word is relaxed by itself
START = -1
SEPARATOR, UNKNOWN = 0, 1


class Index:
    """Suffix array of a symbol array, sorted to ``depth`` symbols."""

    def __init__(self, symbols: np.ndarray, depth: int, bits: int):
        self.bits, self.per = bits, 64 // bits
        self.count = -(-depth // self.per)
        padded = np.concatenate([symbols, np.zeros(self.count * self.per, dtype=symbols.dtype)]).astype(np.uint64)
        n = len(symbols)
        keys = []
        for k in range(self.count):
            key = np.zeros(n, dtype=np.uint64)
            for j in range(k * self.per, (k + 1) * self.per):
                key = (key << np.uint64(bits)) | padded[j : j + n]
            keys.append(key)
        self.order = np.lexsort(keys[::-1])
        self.keys = [key[self.order] for key in keys]

    def ranges(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places in the suffix array whose suffixes begin with each row of ``patterns``."""
        filled = np.arange(patterns.shape[1]) < lengths[:, None]
        top = (1 << self.bits) - 1
        return self._bound(np.where(filled, patterns, 0), False), self._bound(np.where(filled, patterns, top), True)

    def _bound(self, patterns: np.ndarray, after_equal: bool) -> np.ndarray:
        wide = np.full((len(patterns), self.count * self.per), (1 << self.bits) - 1 if after_equal else 0, dtype=np.uint64)
        wide[:, : patterns.shape[1]] = patterns
        wanted = []
        for k in range(self.count):
            key = np.zeros(len(patterns), dtype=np.uint64)
            for j in range(k * self.per, (k + 1) * self.per):
                key = (key << np.uint64(self.bits)) | wide[:, j]
            wanted.append(key)
        low, high = np.zeros(len(patterns), dtype=np.int64), np.full(len(patterns), len(self.order), dtype=np.int64)
        while (low < high).any():
            middle = np.minimum((low + high) // 2, len(self.order) - 1)
            below, equal = np.zeros(len(patterns), dtype=bool), np.ones(len(patterns), dtype=bool)
            for key, want in zip(self.keys, wanted):
                have = key[middle]
                below |= equal & (have < want)
                equal &= have == want
            goes_up = (below | equal if after_equal else below) & (low < high)
            low, high = np.where(goes_up, middle + 1, low), np.where(goes_up | (low >= high), high, middle)
        return low


class SuffixEncoder:
    def __init__(self, path: str):
        self.model = PieceModel(path)
        self.piece_ids = np.array([i for i in self.model.text if self.model.reachable[i]], dtype=np.int32)
        texts = [self.model.text[i] for i in self.piece_ids.tolist()]
        self.lengths = np.array(list(map(len, texts)), dtype=np.int64)
        self.depth = int(self.lengths.max())
        self.symbol = np.full(0x110000, UNKNOWN, dtype=np.uint16)
        for number, char in enumerate(self.model.chars, UNKNOWN + 1):
            self.symbol[ord(char)] = number
        self.patterns = np.zeros((len(texts), self.depth), dtype=np.uint16)
        for row, text in enumerate(texts):
            self.patterns[row, : len(text)] = self.symbol[[ord(c) for c in text]]
        self.known: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one behind the other, and where each begins (one entry more)."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        # The mark itself and a space are the same to the model; every text begins with one.
        marked = pc.replace_substring(texts, SPACE, " ")
        marked = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", marked, ""))
        offsets = np.frombuffer(marked.buffers()[1], dtype=np.int32)[marked.offset : marked.offset + len(marked) + 1]
        data = np.frombuffer(marked.buffers()[2] or b"", dtype=np.uint8)[: offsets[-1]]
        # A word begins at a space that does not follow one, and at the begin of a text.
        blank = data == 0x20
        begins = blank.copy()
        begins[1:] &= ~blank[:-1]
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        begins[: offsets[0]] = False
        cuts = np.append(np.flatnonzero(begins), offsets[-1]).astype(np.int32)
        words = pa.Array.from_buffers(pa.string(), len(cuts) - 1, [None, pa.py_buffer(cuts), marked.buffers()[2]])
        coded = words.dictionary_encode()
        names, index = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        new = [name for name in names if name not in self.known]
        if new:
            self.known.update(zip(new, self._encode_words(new)))
        found = list(map(self.known.__getitem__, names))
        if len(self.known) > REMEMBERED:
            self.known = {}
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        pool = np.frombuffer(b"".join(found), dtype="<u4")
        first = np.cumsum(size) - size
        n = size[index]
        end = np.cumsum(n)
        total = int(end[-1]) if len(end) else 0
        ids = pool[np.arange(total) + np.repeat(first[index] - (end - n), n)]
        edges = np.concatenate([[0], end])[np.searchsorted(cuts[:-1], offsets)]
        return ids, edges

    def _edges(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, end and piece of every occurrence of a piece."""
        there = np.zeros(len(self.model.chars) + 2, dtype=bool)
        there[symbols] = True
        there[[SEPARATOR, UNKNOWN]] = True
        some = there[self.patterns].all(axis=1)
        patterns, lengths, ids = self.patterns[some], self.lengths[some], self.piece_ids[some]
        bits = 16
        if there.sum() < 255:  # short symbols sort faster
            local = np.cumsum(there) - 1
            symbols, patterns, bits = local[symbols], local[patterns], 8
        index = Index(symbols, self.depth, bits)
        low, high = index.ranges(patterns, lengths)
        n = np.maximum(high - low, 0)
        total = int(n.sum())
        place = np.arange(total) + np.repeat(low - (np.cumsum(n) - n), n)
        begin = index.order[place]
        return begin, begin + np.repeat(lengths, n), np.repeat(ids, n)

    def _encode_words(self, words: list[str]) -> list[bytes]:
        code = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        first = np.cumsum(size + 1) - size - 1  # one separator behind each word
        total = int(first[-1] + size[-1] + 1)
        word_of = np.repeat(np.arange(len(words)), size)
        inside = np.arange(len(code)) + word_of
        symbols = np.full(total, SEPARATOR, dtype=np.uint16)
        symbols[inside] = self.symbol[code]
        begin, end, piece = self._edges(symbols)
        origin = np.zeros(total + 1, dtype=np.int64)
        origin[inside] = first[word_of]
        lengthy = np.zeros(total + 1, dtype=bool)
        lengthy[inside] = np.repeat(size > LONG, size)
        # The last piece on the way to each position, and where it begins.
        last = np.full(total + 1, START, dtype=np.int32)
        back = np.zeros(total + 1, dtype=np.int64)
        strange = np.flatnonzero(symbols == UNKNOWN)
        last[strange + 1], back[strange + 1] = START - 1, strange
        depth = end - origin[begin]
        long = lengthy[begin]
        # By position, longest edge first; one number per edge, as that sorts fastest.
        order = np.argsort(np.where(long, 0, depth << 44) | (end << 10) | (1023 - (end - begin)))
        begin, end, piece, depth, long = (v[order] for v in (begin, end, piece, depth, long))
        lone = int(long.sum())
        self._relax_each(begin[:lone], end[:lone], piece[:lone], last, back)
        self._relax_levels(begin[lone:], end[lone:], piece[lone:], depth[lone:], last, back)
        mark = np.full(total, START, dtype=np.int64)
        at, stop = first + size, first
        while len(at):
            mark[back[at]] = last[at]
            on = back[at] > stop
            at, stop = back[at][on], stop[on]
        where = np.flatnonzero(mark != START)
        ids = mark[where]
        owner = np.cumsum(symbols == SEPARATOR)[where]
        unknown = ids < START
        if unknown.any():  # as the bytes of the character
            chars = np.zeros(total, dtype=np.uint32)
            chars[inside] = code
            spelled = [[self.model.byte_ids[b] for b in chr(c).encode()] for c in chars[where[unknown]].tolist()]
            repeat = np.ones(len(ids), dtype=np.int64)
            repeat[unknown] = list(map(len, spelled))
            ids, owner = np.repeat(ids, repeat), np.repeat(owner, repeat)
            ids[ids < START] = [b for each in spelled for b in each]
        data = ids.astype("<u4").tobytes()
        cut = (np.searchsorted(owner, np.arange(len(words) + 1)) * 4).tolist()
        return list(map(data.__getitem__, map(slice, cut[:-1], cut[1:])))

    def _fits(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        fits = np.ones(len(piece), dtype=bool)
        pair = np.flatnonzero(before >= 0)
        fits[pair] = self.model.stays_apart(before[pair], piece[pair])
        return fits

    def _relax_levels(self, begin, end, piece, depth, last, back) -> None:
        """All words at once, by the distance from their begin; the edges at a position one after the other."""
        if not len(end):
            return
        level = np.searchsorted(depth, np.arange(1, int(depth[-1]) + 2))
        for lower, upper in zip(level[:-1].tolist(), level[1:].tolist()):
            group = np.flatnonzero(np.diff(end[lower:upper], prepend=-1)) + lower
            stop = np.append(group[1:], upper)
            while len(group):
                fits = self._fits(last[begin[group]], piece[group])
                hit = group[fits]
                last[end[hit]], back[end[hit]] = piece[hit], begin[hit]
                group, stop = group[~fits] + 1, stop[~fits]
                on = group < stop
                group, stop = group[on], stop[on]

    def _relax_each(self, begin, end, piece, last, back) -> None:
        """Edges one by one, for words so long that their positions outnumber the other words."""
        known: dict[tuple[int, int], bool] = {}
        done = -1
        for b, e, p in zip(begin.tolist(), end.tolist(), piece.tolist()):
            if e == done:
                continue
            before = int(last[b])
            fits = known.get((before, p))
            if fits is None:
                fits = known[before, p] = before < 0 or bool(self.model.stays_apart(np.array([before]), np.array([p]))[0])
            if fits:
                last[e], back[e], done = p, b, e

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.model.spelled.__getitem__, ids.tolist())).removeprefix(b" ").decode("utf-8", "replace")


@functools.cache
def suffix_encoder(path: str) -> SuffixEncoder:
    """One encoder per worker process, kept between tasks."""
    pa.set_cpu_count(1)
    return SuffixEncoder(path)


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)``, one row per input row: whole texts as little-endian unsigned 32-bit ids.

    NULL and empty texts have no ids. Repeated rows give repeated results, an empty table none;
    other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = suffix_encoder(model).encode
        for batch in batches:
            for rows in byte_slices(batch, "text", SLICE_BYTES):
                ids, begins = encode(rows["text"])
                offsets = pa.py_buffer((begins * 4).astype("<i4"))
                packed = pa.Array.from_buffers(pa.binary(), rows.num_rows, [None, offsets, pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([rows["doc_id"], packed], ["doc_id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """``(doc_id, ids, text)`` from ``encode_documents``; a NULL list is an empty text.

    Repeated rows and rows without an id are decoded each on its own; an empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = suffix_encoder(model).decode
        for batch in batches:
            texts = [decode(np.frombuffer(ids or b"", dtype="<u4")) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["ids"], pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")
