"""Words of Arrow text columns as arrays: boundaries, hashes and window hashes of whole blocks of rows.

A word is a maximal run of bytes other than ``\\x20`` and ``\\x09``-``\\x0D``; UTF-8 keeps those bytes out of
longer characters, so words of bytes are words of code points. A word's hash is a Rabin-Karp polynomial
modulo 2**64 over its bytes, and a window's hash one over the mixed hashes of its words. Both come from
prefix sums, so a window costs the same at any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time; bounds the arrays of a task at some 20 times as much.
BLOCK_BYTES = 8 << 20
#: Bytes whose powers are kept.
CHUNK = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: As LOWER, and ASCII signs to spaces: what is left are runs of letters, digits and characters beyond ASCII.
PLAIN = LOWER.copy()
PLAIN[[b for b in range(128) if not chr(b).isalnum()]] = 0x20

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    found = []
    for b in (base, pow(base, -1, 1 << 64)):
        steps = np.full(CHUNK + 1, b, np.uint64)
        steps[0] = 1
        found.append(np.cumprod(steps))
    return found[0], found[1]


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(seed: int) -> tuple[np.ndarray, np.ndarray]:
    if seed not in _TABLES:
        _TABLES[seed] = _powers(_BASES[seed])
    return _TABLES[seed]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (one to one)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Polynomials of ``values[start:end]``; starts and ends ascend. Pieces longer than a chunk are summed by chunks."""
    powers, inverse = _tables(seed)
    out = np.zeros(len(starts), np.uint64)
    done = 0
    while done < len(starts):
        base = int(starts[done])
        upto = int(np.searchsorted(ends, base + CHUNK, "right"))
        if upto <= done:  # one piece longer than a chunk
            end, total = int(ends[done]), np.uint64(0)
            with np.errstate(over="ignore"):
                for at in range(base + (end - 1 - base) // CHUNK * CHUNK, base - 1, -CHUNK):
                    part = values[at : min(at + CHUNK, end)].astype(np.uint64) + np.uint64(1)
                    total = total * powers[CHUNK] + np.sum(part * powers[: len(part)], dtype=np.uint64)
            out[done] = total
            done += 1
            continue
        last = int(ends[upto - 1])
        part = values[base:last].astype(np.uint64)
        part += np.uint64(1)
        part *= powers[: len(part)]
        prefix = np.empty(len(part) + 1, np.uint64)
        prefix[0] = 0
        np.cumsum(part, out=prefix[1:])
        a, b = starts[done:upto] - base, ends[done:upto] - base
        out[done:upto] = (prefix[b] - prefix[a]) * inverse[a]
        done = upto
    return out


@dataclass
class Words:
    """Words of a block of rows: ``rows[r]:rows[r + 1]`` are those of row r, by byte ``starts`` and ``ends``."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray

    def hashes(self, seed: int = 0) -> np.ndarray:
        return mix(_sums(self.data, self.starts, self.ends, seed) + (self.ends - self.starts).astype(np.uint64))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.rows)

    @property
    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), self.counts)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, what = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(what, np.uint8) if what is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def cut(column: pa.Array, table: np.ndarray | None = None) -> Words:
    """The words of a text column, its bytes first replaced by ``table``."""
    data, offsets = buffers(column)
    if table is not None:
        data = table[data]
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        filled = offsets[:-1][offsets[1:] > offsets[:-1]]
        first[filled] = inside[filled]
        filled = offsets[1:][offsets[1:] > offsets[:-1]] - 1
        last[filled] = inside[filled]
    starts = np.flatnonzero(first)
    return Words(data, offsets, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets))


def windows(hashes: np.ndarray, rows: np.ndarray, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``hashes`` at which ``size`` words of one row begin, and the hashes of those windows."""
    left = np.repeat(rows[1:], np.diff(rows)) - np.arange(rows[0], rows[-1])
    at = np.flatnonzero(left >= size)
    return at, mix(_sums(hashes, at, at + size, seed) + np.uint64(size))


def shingles(words: Words, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every ``size``-word window; a row with fewer words, but any, has one over all of them."""
    hashes = words.hashes(seed)
    at, found = windows(hashes, words.rows, size, seed)
    rows = words.row_of[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        a, b = words.rows[short], words.rows[short + 1]
        whole = mix(_sums(hashes, a, b, seed) + (b - a).astype(np.uint64))
        rows, found = np.concatenate([rows, short]), np.concatenate([found, whole])
        order = np.argsort(rows, kind="stable")
        rows, found = rows[order], found[order]
    return rows, found


def blocks(batches: Iterator[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of at most ``limit`` bytes of text, or of one row."""
    for batch in batches:
        column = batch.column(text)
        if not len(column):
            continue
        _, offsets = buffers(column)
        at = 0
        while at < len(column):
            upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield batch.slice(at, upto - at)
            at = upto


def pack(values: np.ndarray, ascending: bool = False) -> bytes:
    """Whole numbers from 0 as compressed planes of bytes; of ascending ones, the steps are kept."""
    values = np.ascontiguousarray(values, np.uint64)
    if ascending and len(values):
        values = np.diff(values, prepend=np.uint64(0))
    top = int(values.max()) if len(values) else 0
    width = max(1, (top.bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    head = len(values).to_bytes(8, "little") + bytes([width, ascending])
    return head + (pa.compress(planes, "zstd", asbytes=True) if planes else b"")


def unpack(packed: bytes) -> np.ndarray:
    n, width, ascending = int.from_bytes(packed[:8], "little"), packed[8], packed[9]
    out = np.zeros((n, 8), np.uint8)
    if n:
        planes = pa.decompress(packed[10:], n * width, "zstd", asbytes=True)
        out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    values = out.reshape(-1).view(np.uint64)
    return np.cumsum(values, dtype=np.uint64) if ascending else values
