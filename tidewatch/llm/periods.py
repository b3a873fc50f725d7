"""Periodic runs of words: stretches that repeat with a period, at least three times over, found by block convolution.

A run is a maximal stretch of words with smallest period q (words q apart are equal) of ``max(MIN_WORDS, MIN_TIMES * q)`` words
or more.

1. Scales. Periods from P to 2P - 1 belong to the scale P, a power of two. The words are cut into aligned blocks of P. A run of such
   a period q has at least 3q words, so it holds a whole block among its first 2P - 1 words, and that block's next occurrence, q words
   further on.
2. Convolution. For each block the sum of squared differences from the words d further on is wanted at all distances d from P to
   2P - 1: the two sums of squares come from prefix sums, the products from a number-theoretic transform of 2P points modulo primes
   whose product exceeds every possible sum. A sum of zero is an occurrence without mismatch, exactly.
3. Extension. An occurrence at distance d grows to both sides while words d apart are equal. Hashes of prefixes find the ends by
   bisection and each stretch is then compared word by word (and grown word by word, should two hashes have collided). Stretches
   that are long enough are runs; the same stretch with several periods keeps the smallest, which divides the others.

Blocks that cannot begin a run are left out before they are transformed, which changes no result: blocks with a word that does not
come again within 2P - 1 words, and blocks that lie with the 2P - 1 words after them inside a run of a period up to P, since two
runs of different periods p < q share fewer than p + q words.

Words are numbered by 64-bit hashes; equal hashes stand for equal words. Null, empty and blank texts have no words and no runs.
Each row is judged by itself, so repeated rows, ids that are shared or null, ties and other columns need no rule; ``digest`` leaves
the text of a row with a null id as it is, as there is no checksum to change it by. Runs lie inside one row, so a row is the unit of
work; memory grows with its number of words (some 150 bytes for each, transforms run over blocks in batches).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import words as W

MIN_WORDS, MIN_TIMES = 24, 3
#: Primes with roots of unity of order 2**25 and more, each with a generator (fixed values).
PRIMES = ((2013265921, 31), (469762049, 3), (167772161, 3))
#: Numbers in the arrays of one batch of transforms.
BATCH = 1 << 18


def _mod(x: np.ndarray, p: int) -> np.ndarray:
    x -= x // np.uint64(p) * np.uint64(p)
    return x


_ROOTS: dict[tuple[int, int], tuple[list[np.ndarray], list[np.ndarray]]] = {}


def _roots(size: int, prime: int, generator: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Powers of the root of unity, and of its inverse, for each halving of a transform of ``size`` points."""
    if (size, prime) not in _ROOTS:
        found: tuple[list, list] = ([], [])
        half = size // 2
        while half:
            root = pow(generator, (prime - 1) // (2 * half), prime)
            for powers, base in zip(found, (root, pow(root, -1, prime)), strict=True):
                steps = np.ones(half, np.uint64)
                done = 1
                while done < half:  # powers double up
                    steps[done : 2 * done] = _mod(steps[: min(done, half - done)] * np.uint64(pow(base, done, prime)), prime)
                    done *= 2
                powers.append(steps)
            half //= 2
        _ROOTS[size, prime] = found
    return _ROOTS[size, prime]


def _forward(x: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Transforms of the rows of ``x``, in bit-reversed order."""
    n, size = x.shape
    half = size // 2
    for roots in _roots(size, prime, generator)[0]:
        pairs = x.reshape(n, -1, 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        total, apart = _mod(a + b, prime), _mod((a + (np.uint64(prime) - b)) % np.uint64(prime) * roots, prime)
        x = np.stack([total, apart], axis=2).reshape(n, size)
        half //= 2
    return x


def _backward(x: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Rows of which ``x`` has the transforms, in bit-reversed order."""
    n, size = x.shape
    half = 1
    for roots in reversed(_roots(size, prime, generator)[1]):
        pairs = x.reshape(n, -1, 2, half)
        a, b = pairs[:, :, 0], _mod(pairs[:, :, 1] * roots, prime)
        x = np.stack([_mod(a + b, prime), _mod(a + (np.uint64(prime) - b), prime)], axis=2).reshape(n, size)
        half *= 2
    return _mod(x * np.uint64(pow(size, -1, prime)), prime)


def occurrences(codes: np.ndarray, blocks: np.ndarray, scale: int, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks and distances ``scale`` to ``2 * scale - 1`` at which the words of a block come again.

    ``blocks`` are the places in ``codes`` at which blocks of ``scale`` words begin; the words after a block end at ``ends``.
    """
    found_blocks, found_distances = [], []
    top = int(codes.max(initial=0))
    primes, room = [], 1
    for prime, generator in PRIMES:
        primes.append((prime, generator))
        room *= prime
        if room > scale * top * top:
            break
    else:
        raise ValueError("more different words than the primes have room for")
    step = max(1, BATCH // (2 * scale))
    for at in range(0, len(blocks), step):
        start, end = blocks[at : at + step], ends[at : at + step]
        block = codes[start[:, None] + np.arange(scale)]
        places = start[:, None] + scale + np.arange(2 * scale)
        inside = places < np.minimum(end, start + 3 * scale - 1)[:, None]
        window = np.where(inside, codes[np.minimum(places, len(codes) - 1)], np.uint64(0))
        zero = start[:, None] + scale + np.arange(scale) + scale <= end[:, None]  # distances that fit
        for prime, generator in primes:
            turned = np.zeros((len(start), 2 * scale), np.uint64)
            turned[:, -np.arange(scale) % (2 * scale)] = _mod(block.copy(), prime)
            product = _mod(_forward(turned, prime, generator) * _forward(_mod(window.copy(), prime), prime, generator), prime)
            cross = _backward(product, prime, generator)[:, :scale]
            squares = _mod(window * window, prime)
            sums = np.cumsum(squares, axis=1)
            theirs = sums[:, scale - 1 : 2 * scale - 1].copy()
            theirs[:, 1:] -= sums[:, : scale - 1]
            own = _mod(block * block, prime).sum(axis=1)
            zero &= _mod(_mod(theirs + own[:, None], prime) + np.uint64(2) * (np.uint64(prime) - cross), prime) == 0
        row, distance = np.nonzero(zero)
        found_blocks.append(start[row])
        found_distances.append(distance + scale)
    if not found_blocks:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_blocks), np.concatenate(found_distances)


class Prefixes:
    """Hashes of all stretches of some words, from prefix sums modulo 2**64."""

    def __init__(self, codes: np.ndarray):
        base = np.uint64(0x9E3779B97F4A7C15)
        self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(codes), base)]))
        values = W.mix(codes + np.uint64(1))
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(values * self.powers[:-1])])

    def same(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether ``n`` words from ``a`` on equal those from ``b`` on, for ``a <= b``."""
        return (self.sums[a + n] - self.sums[a]) * self.powers[b - a] == self.sums[b + n] - self.sums[b]

    def reach(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray, backwards: bool = False) -> np.ndarray:
        """How many words are the same from ``a`` and ``b`` on (or before them), up to ``limit``."""
        low, high = np.zeros(len(a), np.int64), limit.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            shift = middle if backwards else np.int64(0)
            same = self.same(a - shift, b - shift, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def _grown(codes: np.ndarray, start: int, end: int, period: int, first: int, last: int) -> tuple[int, int]:
    """The stretch with a period around the block ``start:end``, word by word, inside ``first:last``."""
    while start > first and codes[start - 1] == codes[start - 1 + period]:
        start -= 1
    end += period
    while end < last and codes[end] == codes[end - period]:
        end += 1
    return start, end


def _extend(codes: np.ndarray, prefixes: Prefixes, block: np.ndarray, distance: np.ndarray, scale: int, first: np.ndarray, last: np.ndarray):
    """The maximal stretches of occurrences, inside ``first:last`` of their rows."""
    left = prefixes.reach(block, block + distance, block - first, backwards=True)
    right = prefixes.reach(block + scale, block + scale + distance, last - block - scale - distance)
    start, end = block - left, block + scale + distance + right
    keys, index = np.unique(np.stack([start, end, distance], axis=1), axis=0, return_index=True)
    keys = keys[keys[:, 1] - keys[:, 0] >= np.maximum(MIN_WORDS, MIN_TIMES * keys[:, 2])]
    wrong = [not np.array_equal(codes[s : e - q], codes[s + q : e]) for s, e, q in keys.tolist()]
    if any(wrong):  # two hashes were equal by chance
        pairs = zip(block.tolist(), distance.tolist(), first.tolist(), last.tolist(), strict=True)
        grown = {(*_grown(codes, b, b + scale, d, f, n), d) for b, d, f, n in pairs}
        keys = np.array(sorted(k for k in grown if k[1] - k[0] >= max(MIN_WORDS, MIN_TIMES * k[2])), np.int64).reshape(-1, 3)
    return keys


def numbered(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words numbered from 1 on inside each row, and how far on each comes again (beyond its row: a large number)."""
    n = len(hashes)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    order = np.lexsort((hashes, row)) if len(rows) > 2 else np.argsort(hashes, kind="stable")
    same = np.zeros(n, bool)
    same[1:] = (hashes[order[1:]] == hashes[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    again = np.full(n, np.iinfo(np.int64).max // 4)
    again[order[:-1][same[1:]]] = np.diff(order)[same[1:]]
    code = np.cumsum(~same)
    begins = np.searchsorted(row[order], np.arange(len(rows) - 1)) if n else np.zeros(len(rows) - 1, np.int64)
    offset = np.where(np.diff(rows) > 0, code[np.minimum(begins, max(n - 1, 0))] - 1 if n else 0, 0)
    codes = np.empty(n, np.uint64)
    codes[order] = (code - offset[row[order]]).astype(np.uint64)
    return codes, again


def runs(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """``row, start, length, period`` of all runs, in this order; ``rows[r]:rows[r + 1]`` are the words of row r."""
    codes, again = numbered(hashes, rows)
    sizes = np.diff(rows)
    found = np.zeros((0, 3), np.int64)
    prefixes = None
    scale = 1
    while MIN_TIMES * scale <= sizes.max(initial=0):
        counts = np.where(sizes >= MIN_TIMES * scale, sizes // scale, 0)
        row = np.repeat(np.arange(len(sizes)), counts)
        blocks = rows[row] + (np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)) * scale
        fits = blocks + 2 * scale <= rows[row + 1]
        row, blocks = row[fits], blocks[fits]
        lonely = np.concatenate([[0], np.cumsum(again >= 2 * scale)])
        open_ = lonely[blocks + scale] == lonely[blocks]
        row, blocks = row[open_], blocks[open_]
        if len(found) and len(blocks):
            # the run that begins last before the block, and of those the one that ends last
            order = np.lexsort((found[:, 1], found[:, 0]))
            reach = np.maximum.accumulate(found[order, 1])
            at = np.searchsorted(found[order, 0], blocks, "right") - 1
            covered = (at >= 0) & (reach[np.maximum(at, 0)] >= np.minimum(blocks + 3 * scale - 1, rows[row + 1]))
            covered &= blocks + 3 * scale - 1 <= rows[row + 1]
            row, blocks = row[~covered], blocks[~covered]
        if len(blocks):
            block, distance = occurrences(codes, blocks, scale, rows[row + 1])
            if len(block):
                prefixes = prefixes or Prefixes(codes)
                of = np.searchsorted(rows, block, "right") - 1
                new = _extend(codes, prefixes, block, distance, scale, rows[of], rows[of + 1])
                found = np.concatenate([found, new])
                order = np.lexsort((found[:, 2], found[:, 1], found[:, 0]))
                found = found[order]
                first = np.ones(len(found), bool)  # of one stretch the smallest period stays
                first[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
                found = found[first]
        scale *= 2
    row = np.searchsorted(rows, found[:, 0], "right") - 1
    out = np.stack([row, found[:, 0] - rows[row], found[:, 1] - found[:, 0], found[:, 2]], axis=1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _row_runs(block: pa.RecordBatch, text: str, place=None) -> tuple[W.Words, np.ndarray, np.ndarray]:
    """Words of a block of rows, the runs of each row, and their places; ``place`` gives each word the word that stands there."""
    words = W.cut(block.column(text))
    hashes = words.hashes()
    which = np.arange(len(hashes)) if place is None else place(words)
    return words, runs(hashes[which], words.rows), which


def stretches(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, start, length, period`` of every run of every row, in words numbered from 0."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in W.blocks(batches, text):
            _, found, _ = _row_runs(block, text)
            columns = [block.column(key).take(pa.array(found[:, 0])), *(pa.array(found[:, k]) for k in (1, 2, 3))]
            yield pa.RecordBatch.from_arrays(columns, [key, "start", "length", "period"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, start long, length long, period long")


def _best(found: np.ndarray) -> tuple[int, int, int]:
    """Start, length and period of the run with the greatest exact length / period; ties by start, then period."""
    ratio = found[:, 2] / found[:, 3]
    near = found[ratio >= ratio.max() * (1 - 1e-12)].tolist()
    return min(((s, n, q) for _, s, n, q in near), key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]))


def _dropped(found: np.ndarray, n: int) -> np.ndarray:
    """Whether each of ``n`` words stands in a run after the run's first period."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, found[:, 1] + found[:, 3], 1)
    np.add.at(steps, found[:, 1] + found[:, 2], -1)
    return np.cumsum(steps[:-1]) > 0


def _rows(docs: DataFrame, key: str, text: str, place, extra: str, of) -> DataFrame:
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_runs long, start long, length long, period long, exponent_milli long, {extra}"
    names = [part.split()[0].strip("`") for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in W.blocks(batches, text):
            keys = block.column(key)
            words, found, which = _row_runs(block, text, place and (lambda w, keys=keys: place(w, keys.to_pylist())))
            cuts = np.searchsorted(found[:, 0], np.arange(len(block) + 1))
            best, more = [], []
            data = words.data.tobytes()
            spans = list(zip(words.starts.tolist(), words.ends.tolist(), strict=True))
            for r in range(len(block)):
                own = found[cuts[r] : cuts[r + 1]]
                a, b = int(words.rows[r]), int(words.rows[r + 1])
                here = which[a:b]
                if len(own):
                    start, length, period = _best(own)
                    best.append((len(own), start, length, period, 1000 * length // period))
                    here = here[~_dropped(own, b - a)]
                else:
                    best.append((0, None, None, None, None))
                more.append(of(own, b" ".join([data[s:e] for s, e in map(spans.__getitem__, here.tolist())])))
            columns = [pa.array(c, pa.int64()) for c in zip(*best, strict=True)]
            columns += [pa.array(c, pa.string()) for c in zip(*more, strict=True)]
            yield pa.RecordBatch.from_arrays([keys, *columns], names)

    return docs.select(key, text).mapInArrow(run, schema)


def collapse(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its number of runs, the one of greatest exponent, and ``collapsed``: the words that stay, joined by one space.

    Of each run its first period stays, unless another run takes a part of that.
    """
    return _rows(docs, key, text, None, "collapsed string", lambda own, kept: (kept.decode(),))


def _planted(words: W.Words, keys: list) -> np.ndarray:
    """The places from which words are taken: in a tenth of the rows, by the checksum of the id, a tail repeats its beginning."""
    which = np.arange(len(words.starts))
    for r, key in enumerate(keys):
        a, b = int(words.rows[r]), int(words.rows[r + 1])
        checksum = None if key is None else zlib.crc32(str(key).encode())
        if checksum is None or checksum % 10 or a == b:
            continue
        g, n = checksum // 10, b - a
        first = g % n
        period = 1 + (n - first) // (3 + g % 8)
        which[a + first : b] = a + first + np.arange(n - first) % period
    return which


def _digests(own: np.ndarray, kept: bytes) -> tuple[str, str]:
    listed = "".join(f"{s},{n},{q}\n" for _, s, n, q in own.tolist())
    return hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def digest(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``collapse`` of the rows with repeats planted in a tenth of them, and SHA-256 sums of all runs and of the words that stay."""
    found = _rows(docs, key, text, _planted, "runs_sha256 string, collapsed_sha256 string", _digests)
    return found.select(key, F.col("n_runs"), "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
