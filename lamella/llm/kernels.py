"""Vectorised text kernels over Arrow string columns.

A column is seen as one UTF-8 byte buffer with row offsets, so words, lines, their hashes and their
counts are array operations over many documents at once. Columns are cut into pieces of about PIECE
bytes (a single longer row makes a longer piece), which bounds memory. Null texts count as empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PIECE = 1 << 21
U = np.uint64
_BASE = U(0x9E3779B97F4A7C15 | 1)
_BASE_INV = U(pow(int(_BASE), -1, 1 << 64))

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CONTINUES = np.zeros(256, bool)
CONTINUES[0x80:0xC0] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * U(0xD6E8FEB86659FD93))
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, PIECE + 4096), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if len(have) <= 4 * PIECE:
            _powers[int(base)] = have
    return have[:n]


def pieces(texts: pa.Array, limit: int = PIECE):
    """Yields (first row, bytes, offsets) of consecutive rows."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
        yield row, data[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends of the maximal runs of True that don't cross a row; and each row's first run (n + 1 entries)."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings data[start:end], by differences of a running polynomial."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_TABLE[data] * powers(_BASE, len(data)), out=total[1:])
    raw = (total[ends] - total[starts]) * powers(_BASE_INV, len(data) + 1)[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * U(0x2545F4914F6CDD1D))


def chained(words: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive word hashes from each of the positions `first`."""
    h = words[first] * U(3) + U(k)
    for j in range(1, k):
        h = mix(h) * U(5) + words[first + j]
    return mix(h)


def windows(row_first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Start positions of all windows of k words inside a row, and each row's first window (n + 1 entries)."""
    counts = np.diff(row_first)
    per = np.maximum(counts - k + 1, 0)
    at = np.zeros(len(per) + 1, np.int64)
    np.cumsum(per, out=at[1:])
    return np.arange(at[-1]) - np.repeat(at[:-1], per) + np.repeat(row_first[:-1], per), at


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False):
    """Starts, ends, first word of each row, and hashes of the white-space separated words."""
    starts, ends, first = runs(~SPACE[data], offsets)
    return starts, ends, first, hashes(LOWER[data] if lower else data, starts, ends)


def shingles_of(h: np.ndarray, first: np.ndarray, k: int):
    """Yields for each row the sorted distinct hashes of its shingles of k words, h[first[r] : first[r + 1]].

    A row with fewer words has one: all of them; a row without words has none.
    """
    counts = np.diff(first)
    at, span = windows(first, k)
    full = chained(h, at, k)
    short = {}
    for n in range(1, k):
        rows = np.flatnonzero(counts == n)
        if len(rows):
            short.update(zip(rows.tolist(), chained(h, first[:-1][rows], n)))
    for r in range(len(counts)):
        if counts[r] >= k:
            yield np.unique(full[span[r] : span[r + 1]])
        elif counts[r]:
            yield np.array([short[r]], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def shingles(data: np.ndarray, offsets: np.ndarray, k: int):
    """shingles_of the lower-cased words of each row."""
    _, _, first, h = words(data, offsets, lower=True)
    yield from shingles_of(h, first, k)


def per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of True (or sum) of mask between consecutive offsets."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return np.diff(total[offsets])


def _flags(chars: str) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(chars.encode())] = True
    return found


#: Symbols that the rules count (fixed by the contract).
SYMBOLS = _flags("#*$%&|<>")


def repeated(words: np.ndarray, first: np.ndarray, k: int = 3) -> np.ndarray:
    """Marks the words that lie in a window of k words found twice or more in their row."""
    marked = np.zeros(len(words), bool)
    at, _ = windows(first, k)
    if len(at):
        row = np.searchsorted(first, at, "right").astype(np.uint64)
        keys = mix(chained(words, at, k) ^ mix(row))
        _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        twice = at[counts[inverse] > 1]
        for j in range(k):
            marked[twice + j] = True
    return marked


def duplicate_lines(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row: lines (between \\n) with a word, and those equal to an earlier one of the row. starts: of the words."""
    begin, end, first = runs(data != 10, offsets)
    if not len(begin):
        return np.zeros(len(offsets) - 1, np.int64), np.zeros(len(offsets) - 1, np.int64)
    worded = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
    row = np.searchsorted(first, np.arange(len(begin)), "right") - 1
    begin, end, row = begin[worded], end[worded], row[worded]
    n = np.bincount(row, minlength=len(offsets) - 1)
    keys = mix(hashes(data, begin, end) ^ mix(row.astype(np.uint64) + U(1)))
    _, at = np.unique(keys, return_index=True)
    return n, n - np.bincount(row[at], minlength=len(offsets) - 1)


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of each row: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (see the quality rules)."""
    starts, _, first, h = words(data, offsets)
    lines, dup = duplicate_lines(data, offsets, starts)
    return {
        "n_words": np.diff(first),
        "word_chars": per_row(~SPACE[data] & ~CONTINUES[data], offsets),
        "n_symbols": per_row(SYMBOLS[data], offsets),
        "n_lines": lines,
        "n_dup_lines": dup,
        "n_repeat_words": per_row(repeated(h, first), first),
    }
