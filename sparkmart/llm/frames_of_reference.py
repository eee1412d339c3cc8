"""Patched frame-of-reference coding of unsigned 32-bit integers, in numpy.

Blocks of 256 values. A block keeps its minimum; the differences to it are packed
at the width that holds ``PERCENTILE`` per cent of them; the others keep their low
bits there and their high bits in an exception list behind the packed bits.

A block is ``minimum u4 | width u1 | exceptions u1 | packed bits | positions u1[] |
high bits u4[]``, little-endian; the caller keeps where each block starts.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256
PERCENTILE = 90
_HEAD = 6


def _lanes(width: int):
    """For each of 32 values: its word, the shift in it, and how many of its bits lie there."""
    for lane in range(32):
        word, shift = divmod(lane * width, 32)
        yield lane, word, shift, 32 - shift


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 256 values below ``2 ** width`` as rows of ``8 * width`` words."""
    lanes = np.ascontiguousarray(values.reshape(-1, 32).T)
    words = np.zeros((width, lanes.shape[1]), np.uint32)
    for lane, word, shift, here in _lanes(width):
        words[word] |= lanes[lane] << np.uint32(shift)
        if here < width:
            words[word + 1] |= lanes[lane] >> np.uint32(here)
    return np.ascontiguousarray(words.T).astype("<u4").view(np.uint8).reshape(len(values), -1)


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    words = np.ascontiguousarray(packed.view("<u4").reshape(-1, width).T)
    lanes = np.empty((32, words.shape[1]), np.uint32)
    for lane, word, shift, here in _lanes(width):
        lanes[lane] = words[word] >> np.uint32(shift)
        if here < width:
            lanes[lane] |= words[word + 1] << np.uint32(here)
    lanes &= np.uint32((1 << width) - 1)
    return lanes.T.reshape(len(packed), BLOCK)


def encode(values: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(block starts with the end as last entry, bytes); a short last block is filled up with its last value."""
    if not len(values):
        return np.zeros(1, "<u4"), b""
    blocks = -(-len(values) // BLOCK)
    full = np.concatenate([values, np.repeat(values[-1:], blocks * BLOCK - len(values))])
    full = full.astype(np.uint32).reshape(blocks, BLOCK)
    low = full.min(axis=1)
    rest = full - low[:, None]
    kth = BLOCK * PERCENTILE // 100 - 1
    # The exponent of a float is the value's bit length (one more where rounding carries); bytes sort by radix.
    bits = (rest.astype(np.float32).view(np.uint32) >> 23).astype(np.uint8)
    width = np.clip(np.sort(bits, axis=1, kind="stable")[:, kth].astype(np.int64) - 126, 0, 32)
    over = rest >> width[:, None].astype(np.uint32)  # a shift by 32 gives 0
    n_over = (over > 0).sum(axis=1)
    starts = np.concatenate([[0], np.cumsum(_HEAD + width * (BLOCK // 8) + 5 * n_over)])
    out = np.zeros(int(starts[-1]), np.uint8)
    head = starts[:-1, None]
    out[head + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(blocks, 4)
    out[starts[:-1] + 4] = width
    out[starts[:-1] + 5] = n_over
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            packed = _pack(rest[own] & np.uint32((1 << int(w)) - 1), int(w))
            out[head[own] + _HEAD + np.arange(packed.shape[1])] = packed
    block, position = np.nonzero(over)
    if len(block):
        place = np.arange(len(block)) - np.repeat(np.cumsum(n_over) - n_over, n_over)
        patch = starts[block] + _HEAD + width[block] * (BLOCK // 8)
        out[patch + place] = position
        high = (patch + n_over[block] + 4 * place)[:, None] + np.arange(4)
        out[high] = over[block, position].astype("<u4").view(np.uint8).reshape(-1, 4)
    return starts.astype("<u4"), out.tobytes()


def decode(starts: np.ndarray, data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The values of blocks ``first`` to before ``last``; the index gives their place, others aren't touched."""
    at = starts[first : len(starts) - 1 if last is None else last].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)
    if not len(at):
        return np.zeros(0, "<u4")
    low = raw[at[:, None] + np.arange(4)].copy().view("<u4").ravel()
    width, n_over = raw[at + 4].astype(np.int64), raw[at + 5].astype(np.int64)
    out = np.zeros((len(at), BLOCK), np.uint32)
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            packed = raw[at[own][:, None] + _HEAD + np.arange(int(w) * (BLOCK // 8))]
            out[own] = _unpack(packed, int(w))
    block = np.repeat(np.arange(len(at)), n_over)
    if len(block):
        place = np.arange(len(block)) - np.repeat(np.cumsum(n_over) - n_over, n_over)
        patch = at[block] + _HEAD + width[block] * (BLOCK // 8)
        high = raw[(patch + n_over[block] + 4 * place)[:, None] + np.arange(4)].copy().view("<u4").ravel()
        out[block, raw[patch + place]] |= high << width[block].astype(np.uint32)
    return (out + low[:, None]).astype("<u4").ravel()
