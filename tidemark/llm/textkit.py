"""Words and hashed word windows of whole texts, by array operations on the UTF-8 bytes of an Arrow batch.

Words are the runs of characters other than space and U+0009 to U+000D. UTF-8 never uses those bytes inside another
character, so bytes can be classified one by one. Hashes are 64-bit, the same in every process and on every machine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
MASK = (1 << 64) - 1

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Bytes hashed in one go; words are never cut.
CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def constants(seed: int, n: int) -> np.ndarray:
    """n odd 64-bit multipliers, from a rule."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15)
    return mix(steps + U(seed * 0xD1342543DE82EF95 & MASK)) | U(1)


BYTE = constants(11, 256)
BASE = 0xD6E8FEB86659FD95  # odd, and 5 modulo 8
UNBASE = pow(BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out) if n else out


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values of a string column, one after the other, and where each begins; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def spans(keep: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs where keep holds; runs end where a text does."""
    n = len(keep)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = np.empty(n, bool), np.empty(n, bool)
    first[0] = last[-1] = True
    first[1:] = ~keep[:-1]
    last[:-1] = ~keep[1:]
    inner = at[(at > 0) & (at < n)]
    first[inner] = True
    last[inner - 1] = True
    return np.flatnonzero(keep & first), np.flatnonzero(keep & last) + 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span. Spans are in order and don't overlap."""
    out = np.empty(len(starts), np.uint64)
    i, up, down = 0, powers(BASE, 0), powers(UNBASE, 0)
    while i < len(starts):
        a = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, a + CHUNK, "right")))
        b = ends[j - 1]
        if len(up) < b - a:
            n = max(int(b - a), int(min(CHUNK, len(data))))
            up, down = powers(BASE, n), powers(UNBASE, n)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(BYTE[data[a:b]] * up[: b - a], out=sums[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        size = e - s
        value = (sums[e] - sums[s]) * down[np.minimum(s, b - a - 1)]
        out[i:j] = mix(value + size.astype(np.uint64) * U(0x9E3779B97F4A7C15))
        i = j
    return out


class Words:
    """The words of a batch: hash, start and end of each (bytes of `data`), and `at`, where the words of each text begin."""

    def __init__(self, column: pa.Array, lower: bool = False, space: np.ndarray = SPACE):
        raw, self.text_at = utf8(column)
        self.raw = raw
        self.data = LOWER[raw] if lower else raw
        self.starts, self.ends = spans(~space[raw], self.text_at)
        self.hash = hash_spans(self.data, self.starts, self.ends)
        self.at = np.searchsorted(self.starts, self.text_at)
        self.n = np.diff(self.at)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.n)), self.n)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """A hash for each window of k words inside one text, and where the windows of each text begin."""
        counts = np.maximum(self.n - k + 1, 0)
        at = np.concatenate([[0], np.cumsum(counts)])
        total = len(self.hash) - k + 1
        if total <= 0 or at[-1] == 0:
            return np.zeros(0, np.uint64), at
        sums = np.zeros(total, np.uint64)
        for j, c in enumerate(constants(101 + k, k)):
            sums += self.hash[j : j + total] * c
        index = np.repeat(self.at[:-1] - at[:-1], counts) + np.arange(at[-1])
        return mix(sums[index]), at


def per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of flags between the borders at."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[at[1:]] - sums[at[:-1]]


def sort_texts(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sort the values of each text in place."""
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        values[a:b].sort()
    return values


def distinct(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each text, sorted, and where those of each text begin."""
    values = sort_texts(values, at)
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[at[:-1][np.diff(at) > 0]] = True
    return values[keep], np.concatenate([[0], np.cumsum(per_text(keep, at))])


def shingles(column: pa.Array, k: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The set of distinct k-word shingles of each text, hashed: sorted values, and where each set begins.

    A text with fewer than k words, but one at least, has its whole sequence as its only shingle.
    """
    words = Words(column, lower)
    values, at = words.windows(k)
    short = np.flatnonzero((words.n > 0) & (words.n < k))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for j, c in enumerate(constants(77, k)):
            there = words.n[short] > j
            whole[there] += words.hash[words.at[short[there]] + j] * c
        values = np.insert(values, at[short], mix(whole + words.n[short].astype(np.uint64)))
        add = np.zeros(len(words.n), np.int64)
        add[short] = 1
        at = at + np.concatenate([[0], np.cumsum(add)])
    return distinct(values, at)
