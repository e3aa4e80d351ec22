"""Patched frame-of-reference blocks of 32-bit ids.

Ids are cut into blocks of 128. From each block its minimum is subtracted. A percentile of the
differences chooses the width at which the block is packed, as ``width`` bit planes of 16 bytes;
differences that need more bits are exceptions with position and value. The index holds the start
of every block, so a range of ids is read without decoding what lies before.

Layout, little-endian: ``magic, ids, blocks`` (u32 each), then per block ``start u32``, ``minimum
u32``, ``width u8``, ``exceptions u8``, each as one array, then the bodies (planes, exception
positions u8, exception differences u32).
"""

import numpy as np

BLOCK = 128
PLANE = BLOCK // 8
PERCENTILE = 0.9
MAGIC = 0x31524650
HEAD = 12


def bit_length(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1]


def encode(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    ids = np.ascontiguousarray(ids, dtype="<u4")
    count = len(ids)
    blocks = -(-count // BLOCK)
    head = np.array([MAGIC, count, blocks], dtype="<u4").tobytes()
    if not count:
        return head
    rows = np.full(blocks * BLOCK, ids[-1], dtype=np.uint32)
    rows[:count] = ids
    rows = rows.reshape(blocks, BLOCK)
    low = rows.min(axis=1)
    rows = rows - low[:, None]
    place = max(int(np.ceil(percentile * BLOCK)) - 1, 0)
    width = bit_length(np.partition(rows, place, axis=1)[:, place])
    over = bit_length(rows.max(axis=1)) > width
    at, where = np.nonzero((rows[over].astype(np.uint64) >> width[over, None].astype(np.uint64)) > 0)
    at = np.flatnonzero(over)[at]
    extra = np.bincount(at, minlength=blocks)
    size = width * PLANE + extra * 5
    start = np.cumsum(size) - size
    body = np.zeros(int(size.sum()), dtype=np.uint8)
    step = np.arange(PLANE)
    for bit in range(int(width.max(initial=0))):
        some = np.flatnonzero(width > bit)
        plane = np.packbits((rows[some] >> np.uint32(bit)).astype(np.uint8) & 1, axis=1)
        body[(start[some] + bit * PLANE)[:, None] + step] = plane
    nth = np.arange(len(at)) - (np.cumsum(extra) - extra)[at]
    tail = start[at] + width[at] * PLANE
    body[tail + nth] = where
    values = rows[at, where].astype("<u4").view(np.uint8).reshape(-1, 4)
    body[(tail + extra[at] + nth * 4)[:, None] + np.arange(4)] = values
    index = (start.astype("<u4"), low.astype("<u4"), width.astype(np.uint8), extra.astype(np.uint8))
    return b"".join([head, *(a.tobytes() for a in index), body.tobytes()])


def decode(data: bytes, begin: int = 0, end: int | None = None) -> np.ndarray:
    """Ids ``begin`` to ``end``; only their blocks are touched."""
    magic, count, blocks = np.frombuffer(data, dtype="<u4", count=3).tolist()
    if magic != MAGIC:
        raise ValueError("not a block of packed ids")
    end = count if end is None else min(end, count)
    if begin >= end:
        return np.empty(0, dtype="<u4")
    first, last = begin // BLOCK, -(-end // BLOCK)

    def column(offset: int, kind: str) -> np.ndarray:
        item = np.dtype(kind).itemsize
        return np.frombuffer(data, dtype=kind, count=last - first, offset=HEAD + offset * blocks + first * item)

    start, low = column(0, "<u4").astype(np.int64), column(4, "<u4")
    width, extra = column(8, "u1").astype(np.int64), column(9, "u1").astype(np.int64)
    body = np.frombuffer(data, dtype=np.uint8, offset=HEAD + 10 * blocks)
    rows = np.zeros((last - first, BLOCK), dtype=np.uint32)
    step = np.arange(PLANE)
    for bit in range(int(width.max(initial=0))):
        some = np.flatnonzero(width > bit)
        plane = np.unpackbits(body[(start[some] + bit * PLANE)[:, None] + step], axis=1)
        rows[some] |= plane.astype(np.uint32) << np.uint32(bit)
    if extra.any():
        at = np.repeat(np.arange(len(extra)), extra)
        nth = np.arange(len(at)) - (np.cumsum(extra) - extra)[at]
        tail = start[at] + width[at] * PLANE
        value = body[(tail + extra[at] + nth * 4)[:, None] + np.arange(4)]
        rows[at, body[tail + nth]] = np.ascontiguousarray(value).view("<u4").ravel()
    rows += low[:, None]
    return rows.ravel()[begin - first * BLOCK : end - first * BLOCK].astype("<u4", copy=False)
