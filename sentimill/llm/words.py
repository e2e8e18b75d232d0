"""Word hashing over Arrow text columns, vectorised with numpy.

Texts are read straight from the Arrow buffers (UTF-8 bytes, no Python strings). A word is
a maximal run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z; every
byte above 0x7F belongs to a word, so working on bytes equals working on code points.
Each word becomes a 64-bit hash. Texts are handled in groups of about ``PIECE`` bytes, so
memory does not follow the size of an Arrow batch; a longer text is cut between words and
its parts are joined again, so the words of a whole text always come together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
SHINGLE = 5

_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_IS_WORD = ((_LOWER >= 48) & (_LOWER <= 57)) | ((_LOWER >= 97) & (_LOWER <= 122)) | (_LOWER >= 128)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}

#: odd multipliers of the words of a shingle, from the golden-ratio sequence
_STEP = [np.uint64((0xD1342543DE82EF95 * (2 * i + 1)) % (1 << 64) | 1) for i in range(SHINGLE)]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (multiply and xor-shift rounds)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        p = np.full(max(n, PIECE + 4096), base, dtype=np.uint64)
        p[0] = 1
        have = _powers[kind] = np.multiply.accumulate(p)
    return have[:n]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    a = column.cast(pa.large_string()).fill_null("")
    _, off, data = a.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[a.offset:a.offset + len(a) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def _hash_words(raw: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, start bytes) of the words of ``raw``; no word crosses a position in ``breaks``."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = _IS_WORD[raw]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    cut = breaks[(breaks >= 0) & (breaks < n)]
    before[cut] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cut[cut > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * _power("up", _BASE, n), out=total[1:])
    h = (total[end] - total[start]) * _power("down", _INVERSE, n)[start]
    return mix(h + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)), start


def word_hash(word: str) -> int:
    """The hash that a single word has in the arrays of ``groups``."""
    raw = np.frombuffer(word.encode(), dtype=np.uint8)
    h, _ = _hash_words(raw, np.zeros(0, np.int64))
    assert len(h) == 1, word
    return int(h[0])


def ranges(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``size`` bytes: (first, one past the last)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def groups(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, word offsets): the words of a run of whole texts.

    The words of row ``first + k`` are ``hashes[offsets[k]:offsets[k + 1]]``.
    """
    raw, offsets = buffers(column)
    for i, j in ranges(offsets, PIECE):
        lo, hi = int(offsets[i]), int(offsets[j])
        if hi - lo <= 2 * PIECE:
            h, start = _hash_words(raw[lo:hi], offsets[i:j] - lo)
            yield i, h, np.searchsorted(start, offsets[i:j + 1] - lo)
            continue
        parts, at = [], lo  # one long text
        while at < hi:
            to = min(hi, at + PIECE)
            while to < hi and _IS_WORD[raw[to]]:
                ahead = raw[to:to + PIECE]
                stop = np.flatnonzero(~_IS_WORD[ahead])
                to += int(stop[0]) if len(stop) else len(ahead)
            parts.append(_hash_words(raw[at:to], np.zeros(0, np.int64))[0])
            at = to
        h = np.concatenate(parts)
        yield i, h, np.array([0, len(h)])


def shingles(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, offsets by text) of runs of five words.

    A text of one to four words has one shingle of all its words; one without words none.
    """
    count = np.diff(offsets)
    n = len(hashes)
    if n >= SHINGLE:
        s = np.zeros(n - SHINGLE + 1, np.uint64)
        for k, step in enumerate(_STEP):
            s += hashes[k:n - SHINGLE + 1 + k] * step
        s = mix(s)
    else:
        s = np.zeros(0, np.uint64)
    made = np.where(count >= SHINGLE, count - SHINGLE + 1, (count > 0).astype(count.dtype))
    out_off = np.concatenate([[0], np.cumsum(made)])
    out = np.empty(int(out_off[-1]), np.uint64)
    keep = np.zeros(n, bool)
    if len(s):
        # a shingle starts at each word that has four more of its own text behind it
        last = np.repeat(offsets[1:], count)
        keep = np.arange(n) + SHINGLE <= last
        whole = np.repeat(count >= SHINGLE, made)
        out[whole] = s[keep[:len(s)]]
    for k in np.flatnonzero((count > 0) & (count < SHINGLE)):
        h = np.uint64(0x51ED270B0F1A4D35)
        for w in hashes[offsets[k]:offsets[k + 1]]:
            h = mix(np.array([h], np.uint64) * _BASE + w)[0]
        out[out_off[k]] = h
    return out, out_off


def sequence_keys(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One signed 64-bit key per text for its whole sequence of words."""
    n = len(hashes)
    total = np.zeros(n + 1, np.uint64)
    pos = np.arange(n) - np.repeat(offsets[:-1], np.diff(offsets))
    # position-dependent mixing makes the sum depend on the order of the words
    np.cumsum(mix(hashes + mix(pos.astype(np.uint64) + np.uint64(1))), out=total[1:])
    key = total[offsets[1:]] - total[offsets[:-1]]
    return mix(key + np.diff(offsets).astype(np.uint64) * _BASE).view(np.int64)
