"""Token ids of whole texts, batch by batch, for use inside Arrow tasks.

``BatchEncoder.encode`` gives exactly what the ``tokenizers`` library gives for each text, with one
end id appended. For the kind of file whose pipeline is NFC, white space to a space, lower case and a
split into letter runs, digits and other runs, ids depend on the split pieces alone. Most pieces
repeat, so a batch is split with Arrow, and the library encodes each piece once in one call.
Texts with characters for which the split is not this simple, and all other tokenizer files, go
through the library text by text.
"""

import contextlib
import ctypes
import functools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 1
SLICE_BYTES = 4 << 20
# About what a worker may remember of pieces between batches; a bound on memory, without effect on results.
REMEMBERED_BYTES = 64 << 20
ENTRY_BYTES = 200  # a table entry with its two objects, beside their contents

# The pipeline for which pieces can be encoded one by one.
PIECE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
# ASCII without control characters and apostrophe, and Latin-1 from the no-break space on: stable
# under NFC, lower-cased letter by letter, without contractions. "<|" may begin a special token.
NOT_PLAIN = r"[^\t-\r -&(-~\x{a0}-\x{ff}]|<\|"
LETTERS, NUMBERS = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
OTHER_RUN = rf"([{NUMBERS}]|[^{LETTERS}{NUMBERS}\t-\r \x{{a0}}]+)"


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def byte_slices(table: pa.RecordBatch | pa.Table, column: str, limit: int = SLICE_BYTES) -> Iterator:
    """Row slices whose texts take about ``limit`` bytes at most, one row at least."""
    sizes = pc.fill_null(pc.binary_length(table[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    begin = held = 0
    for row, size in enumerate(sizes.tolist()):
        if row > begin and held + size > limit:
            yield table.slice(begin, row - begin)
            begin, held = row, 0
        held += size
    if begin < len(sizes):
        yield table.slice(begin)


def release_memory() -> None:
    """Give freed memory back to the system. Workers stay idle beside the executor's JVM after their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # there with glibc only
    if trim is not None:
        trim(0)


class BatchEncoder:
    def __init__(self, path: str, end_id: int = END_ID):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.pieces = Tokenizer(self.whole.model)
        self.end_id = end_id
        self.plain = self._splits_into_pieces(path)
        self.alphabet = byte_alphabet()
        self.known: dict[str, bytes] = {}
        self.remembered = 0

    @staticmethod
    def _splits_into_pieces(path: str) -> bool:
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        split, *_ = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        return (
            parts["model"].get("type") == "BPE"
            and not parts["model"].get("dropout")
            and [n.get("type") for n in (parts.get("normalizer") or {}).get("normalizers", [])] == NORMALIZERS
            and split.get("pattern") == {"Regex": PIECE_PATTERN}
            and all("<|" in token["content"] for token in parts.get("added_tokens", []))
        )

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with its end id, and where each text begins (one entry more)."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        count = len(texts)
        if self.plain:
            slow = pc.match_substring_regex(texts, NOT_PLAIN).to_numpy(zero_copy_only=False)
        else:
            slow = np.ones(count, dtype=bool)
        by_pieces, by_text = np.flatnonzero(~slow), np.flatnonzero(slow)
        ids, lengths = [], np.zeros(count, dtype=np.int64)
        if len(by_pieces):
            found, lengths[by_pieces] = self._by_pieces(texts.take(pa.array(by_pieces)))
            ids.append(found)
        for row in by_text.tolist():
            one = np.array(self.whole.encode(texts[row].as_py(), add_special_tokens=False).ids, dtype="<u4")
            lengths[row] = len(one)
            ids.append(one)
        # Put both kinds in row order, with the end id behind each.
        starts = np.concatenate([[0], np.cumsum(lengths + 1)])
        out = np.full(starts[-1], self.end_id, dtype="<u4")
        rows = np.concatenate([by_pieces, by_text])
        if len(rows):
            flat, n = np.concatenate(ids), lengths[rows]
            out[np.repeat(starts[rows] - (np.cumsum(n) - n), n) + np.arange(len(flat))] = flat
        return out, starts

    def _by_pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        apart = pc.replace_substring_regex(pc.utf8_lower(texts), OTHER_RUN, r" \1 ")
        split = pc.utf8_split_whitespace(apart)
        del apart
        coded = split.flatten().dictionary_encode()
        names, index = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        self._learn([name for name in names if name not in self.known])
        found = list(map(self.known.__getitem__, names))
        if self.remembered > REMEMBERED_BYTES:
            self.forget()
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        pool = np.frombuffer(b"".join(found), dtype="<u4")
        begin = np.cumsum(size) - size
        n = size[index]
        end = np.cumsum(n)
        total = int(end[-1]) if len(end) else 0
        ids = pool[np.arange(total) + np.repeat(begin[index] - (end - n), n)]
        edges = np.concatenate([[0], end])[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return ids, np.diff(edges)

    def _learn(self, names: list[str]) -> None:
        if "" in names:
            names.remove("")
            self.known[""] = b""
        if not names:
            return
        spelled = [name.encode().decode("latin-1").translate(self.alphabet) for name in names]
        found = self.pieces.encode(spelled, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found.ids, dtype="<u4").tobytes()
        cut = (np.searchsorted(np.array(found.word_ids), np.arange(len(names) + 1)) * 4).tolist()
        self.known.update(zip(names, map(ids.__getitem__, map(slice, cut[:-1], cut[1:]))))
        self.remembered += sum(map(len, names)) + len(ids) + ENTRY_BYTES * len(names)

    def forget(self) -> None:
        self.known, self.remembered = {}, 0


@functools.cache
def encoder(path: str, end_id: int = END_ID) -> BatchEncoder:
    """One encoder per worker process, kept between tasks."""
    pa.set_cpu_count(1)
    return BatchEncoder(path, end_id)


@contextlib.contextmanager
def encoding(path: str, end_id: int = END_ID) -> Iterator[BatchEncoder]:
    """The worker's encoder for the length of a task. What it learned stays, within its bound; other memory goes back."""
    try:
        yield encoder(path, end_id)
    finally:
        release_memory()
