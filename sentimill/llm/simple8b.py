"""Simple-8b: word-aligned packing of integers, vectorised with numpy.

A 64-bit word holds a selector in its upper four bits and, in the other sixty, as many
values as the selector says, all of one width, the first value lowest. Values are packed
in blocks of ``BLOCK``; a word never crosses a block, so every block can be decoded from
its first word on. The last word of a block may have room for more values than are left.

Values of more than ``ESCAPE_BITS`` bits are escapes: their place in the words holds 0, and
(position, value) is kept beside the words, so that a rare wide value neither thins the
words around it nor bounds what can be stored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK = 512
ESCAPE_BITS = 30

# FIXED VALUES of the coding: values in a word, bits of each, by selector
COUNTS = (240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)

_COUNT = np.array(COUNTS, np.int64)
_U = np.uint64


@dataclass
class Packed:
    """``n`` values: the words, the first word of each block (and the end), the escapes."""
    n: int
    words: np.ndarray        # uint64
    blocks: np.ndarray       # int64, one more than there are blocks
    escape_at: np.ndarray    # int64, ascending
    escape_value: np.ndarray  # uint64


def _selectors(bits: np.ndarray) -> np.ndarray:
    """For each value of each block (a row, padded with 240 zeros) the selector that packs
    the most values from there on."""
    width = bits.shape[1] - COUNTS[0]
    # running maxima over 1, 2, 3, ... values, each from shorter ones
    tops = {1: bits}
    for c in sorted(COUNTS)[1:]:
        k = max(x for x in tops if x < c)  # two windows of k (they overlap if k > c / 2)
        while 2 * k < c:
            tops[2 * k] = np.maximum(tops[k][:, :-k], tops[k][:, k:])
            k *= 2
        w = tops[k]
        tops[c] = np.maximum(w[:, :w.shape[1] - (c - k)], w[:, c - k:])
    best = np.full((bits.shape[0], width), len(COUNTS) - 1, np.uint8)
    for s in range(len(COUNTS) - 1, -1, -1):
        np.copyto(best, np.uint8(s), where=tops[COUNTS[s]][:, :width] <= WIDTHS[s])
    return best


def pack(values: np.ndarray) -> Packed:
    """The packed form of unsigned integers of up to 64 bits."""
    v = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(v)
    wide = np.flatnonzero(v >> _U(ESCAPE_BITS))
    escaped = v[wide]
    if len(wide):
        v = v.copy()
        v[wide] = 0
    n_blocks = -(-n // BLOCK)
    if n_blocks == 0:
        return Packed(0, np.zeros(0, np.uint64), np.zeros(1, np.int64), wide, escaped)
    bits = np.zeros((n_blocks, BLOCK + COUNTS[0]), np.uint8)
    flat = np.zeros(n_blocks * BLOCK, np.uint8)
    flat[:n] = np.frexp(v.astype(np.float64))[1]  # bit lengths
    bits[:, :BLOCK] = flat.reshape(n_blocks, BLOCK)
    best = _selectors(bits)
    length = np.full(n_blocks, BLOCK, np.int64)
    length[-1] = n - (n_blocks - 1) * BLOCK
    # all blocks take their next word at the same time
    at = np.zeros(n_blocks, np.int64)
    lane = np.arange(n_blocks)
    starts, used = [], []
    while len(lane):
        s = best[lane, at]
        starts.append((lane, at))
        used.append(s)
        at = at + _COUNT[s]
        more = at < length[lane]
        lane, at = lane[more], at[more]
    lanes = np.concatenate([a for a, _ in starts])
    begin = np.concatenate([a for _, a in starts])
    sel = np.concatenate(used)
    order = np.argsort(lanes, kind="stable")  # by block; within it the words came in order
    lanes, begin, sel = lanes[order], begin[order] + lanes[order] * BLOCK, sel[order]
    blocks = np.concatenate([[0], np.cumsum(np.bincount(lanes, minlength=n_blocks))])
    end = lanes * BLOCK + length[lanes]
    words = sel.astype(np.uint64) << _U(60)
    padded = np.concatenate([v, np.zeros(1, np.uint64)])  # what lies behind a block is 0
    for s in np.unique(sel):
        if not WIDTHS[s]:
            continue
        idx = np.flatnonzero(sel == s)
        put = words[idx]
        for j in range(COUNTS[s]):
            src = begin[idx] + j
            put |= padded[np.where(src < end[idx], src, n)] << _U(j * WIDTHS[s])
        words[idx] = put
    return Packed(n, words, blocks, wide, escaped)


def unpack(p: Packed) -> np.ndarray:
    """The values of ``pack``, as uint64."""
    out = np.zeros(p.n, np.uint64)
    if p.n:
        sel = (p.words >> _U(60)).astype(np.int64)
        count = _COUNT[sel]
        per = np.diff(p.blocks)
        block = np.repeat(np.arange(len(per)), per)
        before = np.cumsum(count) - count
        begin = before - np.repeat(before[p.blocks[:-1]], per) + block * BLOCK
        end = np.minimum((block + 1) * BLOCK, p.n)
        for s in np.unique(sel):
            if not WIDTHS[s]:
                continue
            idx = np.flatnonzero(sel == s)
            w, to, stop = p.words[idx], begin[idx], end[idx]
            mask = _U((1 << WIDTHS[s]) - 1)
            for j in range(COUNTS[s]):
                ok = to + j < stop
                out[to[ok] + j] = (w[ok] >> _U(j * WIDTHS[s])) & mask
    out[p.escape_at] = p.escape_value
    return out


def to_bytes(p: Packed) -> tuple[bytes, bytes, bytes]:
    """(words, blocks, escapes) as little-endian bytes; blocks are 32-bit, escapes pairs of 64 bits."""
    pairs = np.empty((len(p.escape_at), 2), "<u8")
    pairs[:, 0], pairs[:, 1] = p.escape_at, p.escape_value
    return p.words.astype("<u8").tobytes(), p.blocks.astype("<u4").tobytes(), pairs.tobytes()


def from_bytes(n: int, words: bytes, blocks: bytes, escapes: bytes) -> Packed:
    pairs = np.frombuffer(escapes, "<u8").reshape(-1, 2)
    return Packed(n, np.frombuffer(words, "<u8"), np.frombuffer(blocks, "<u4").astype(np.int64),
                  pairs[:, 0].astype(np.int64), pairs[:, 1])
