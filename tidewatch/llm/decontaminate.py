"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact check.

Texts are read in lower case (A-Z) with ASCII signs as spaces. An item of n words has a multiset of
``SIZE``-word shingles (of n words, if it has fewer), each weighing as often as it stands there. Windows of n
words, one from each word on, are its counterparts in a document; a shorter document is one window. The
operator finds the windows whose weighted Jaccard similarity with the item is at least ``SIMILARITY``:

1. Windows too few of whose shingles stand in any item to reach that similarity are left out (an exact bound).
2. The others get a SimHash of 128 bits. Items of that length are indexed by the 8 blocks of 16 bits of theirs: of two
   fingerprints at most 31 bits apart, some block differs in at most 3 bits, so all of those are found. An item's
   blocks are kept with all values one bit away, and a window's are looked up with all values up to two bits away. Some 8 % of unrelated
   items are retrieved. At the limit of similarity 20 bits are expected to differ, with a standard error of 4.
3. Candidates are verified on the full multisets.

The benchmark is measured first and read in blocks of at most ``BENCHMARK_BYTES`` of text, one search and one scan of the
documents each; equal items count once, as the smallest id. Null and empty texts match nothing, on either side. An item
without an id is an item like others, reported as null, after all ids where items tie. Documents are judged
row by row, without a shuffle; reports merge rows that share an id. Null ids of documents are reported as null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import words as W

SIZE = 5
SIMILARITY = 0.8
RADIUS = 31
#: Text of a benchmark block held by each task.
BENCHMARK_BYTES = 16 << 20
#: Windows fingerprinted at a time.
SLICE = 2048

_BLOCKS, _BITS = 8, 16
_FILTER_BITS = 22


def _flips(most: int) -> np.ndarray:
    """All values of a block with at most that many bits set."""
    return np.array([sum(1 << b for b in c) for n in range(most + 1) for c in combinations(range(_BITS), n)], np.int32)


#: Bits of a block that the index flips in items and the search in windows: together at least ``RADIUS // _BLOCKS``.
_OF_ITEMS = _flips(1)
_OF_WINDOWS = _flips(RADIUS // _BLOCKS - 1)


def _expand(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges lo:hi, the number of the range and each place in it."""
    n = hi - lo
    which = np.repeat(np.arange(len(lo)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + lo[which]


def simhash(shingles: np.ndarray) -> np.ndarray:
    """Fingerprints (two words) of rows of equally many shingle hashes: a bit is set if most shingles set it."""
    lanes = np.stack([shingles, W.mix(shingles + np.uint64(0x9E3779B97F4A7C15))], axis=2)
    bits = np.unpackbits(lanes.view(np.uint8), axis=2)
    return np.packbits(2 * bits.sum(axis=1, dtype=np.int32) > shingles.shape[1], axis=1).view(np.uint64)


def similarity(pair_a: np.ndarray, a: np.ndarray, pair_b: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Weighted Jaccard similarity of two multisets for each of n pairs, given as (pair, element)."""

    def numbered(pair: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((x, pair))
        pair, x = pair[order], x[order]
        new = np.concatenate([[True], (pair[1:] != pair[:-1]) | (x[1:] != x[:-1])]) if len(x) else np.zeros(0, bool)
        heads = np.flatnonzero(new)
        return pair, x, np.arange(len(x)) - np.repeat(heads, np.diff(np.append(heads, len(x))))

    both = [np.concatenate(c) for c in zip(numbered(pair_a, a), numbered(pair_b, b), strict=True)]
    pair, x, nth = (c[np.lexsort((both[2], both[1], both[0]))] for c in both)
    same = (pair[1:] == pair[:-1]) & (x[1:] == x[:-1]) & (nth[1:] == nth[:-1])
    common = np.bincount(pair[1:][same], minlength=n)
    return common / np.maximum(np.bincount(pair, minlength=n) - common, 1)


class Items:
    """A block of benchmark items, indexed by length."""

    def __init__(self, ids: list, texts: list[str | None]):
        order = sorted((i for i in range(len(ids)) if ids[i] is not None), key=lambda i: ids[i])
        order += [i for i in range(len(ids)) if ids[i] is None]
        words = W.cut(pa.array([texts[i] for i in order], pa.string()), W.PLAIN)
        rows, hashes = W.shingles(words, SIZE)
        bounds = np.searchsorted(rows, np.arange(len(order) + 1))
        self.ids, self.lists, self.classes, seen = [], [], {}, set()
        for r, i in enumerate(order):
            own = np.sort(hashes[bounds[r] : bounds[r + 1]])
            if len(own) and (key := (int(words.counts[r]), own.tobytes())) not in seen:
                seen.add(key)
                self.classes.setdefault(key[0], []).append(len(self.ids))
                self.ids.append(ids[i])
                self.lists.append(own)
        self.bounds = np.cumsum([0, *map(len, self.lists)])
        self.flat = np.concatenate([np.zeros(0, np.uint64), *self.lists])
        self.known = np.unique(self.flat)
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.known >> np.uint64(64 - _FILTER_BITS)] = True
        self.index = {}
        for length, members in self.classes.items():
            prints = simhash(np.stack([self.lists[m] for m in members]))
            values = (self._blocks(prints)[:, :, None] ^ _OF_ITEMS).reshape(len(members), -1)
            order = np.argsort(values, axis=None, kind="stable")
            values = values.ravel()[order]
            present = np.zeros(_BLOCKS << _BITS, np.uint8)
            present[values] = 1
            self.index[length] = (np.array(members), prints, np.packbits(present), values, order // (_BLOCKS * len(_OF_ITEMS)))

    @staticmethod
    def _blocks(prints: np.ndarray) -> np.ndarray:
        """Each fingerprint's blocks, with their numbers above their values."""
        return prints.view(np.uint16).astype(np.int32) + (np.arange(_BLOCKS, dtype=np.int32) << _BITS)

    def _retrieved(self, length: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints and places of items (of that length) of which some block differs in few bits."""
        members, _, present, values, at_item = self.index[length]
        probes = (self._blocks(prints)[:, :, None] ^ _OF_WINDOWS).reshape(len(prints), -1)
        which, column = np.nonzero((present[probes >> 3] << (probes & 7).astype(np.uint8)) & 128)
        probe = probes[which, column]
        each, at = _expand(*(np.searchsorted(values, probe, side) for side in ("left", "right")))
        return np.divmod(np.unique(which[each] * len(members) + at_item[at]), len(members))

    def _candidates(self, length: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows and items (of that length) whose fingerprints are within the radius."""
        members, own = self.index[length][:2]
        # windows of copies are alike: each different fingerprint is looked for once
        different, number = np.unique(prints, axis=0, return_inverse=True)
        which, item = self._retrieved(length, different)
        near = np.bitwise_count(different[which] ^ own[item]).sum(axis=1) <= RADIUS
        which, item = which[near], item[near]
        lo, hi = (np.searchsorted(which, number, side) for side in ("left", "right"))
        window, at = _expand(lo, hi)
        return window, members[item[at]]

    def _windows(self, words: W.Words, size: int, at: np.ndarray, found: np.ndarray, lengths: list[int]):
        """Per length, ``(length, shingles, first places)`` of the windows worth a fingerprint."""
        known = self.filter[found >> np.uint64(64 - _FILTER_BITS)]
        places = np.flatnonzero(known)
        places = places[self.known[np.minimum(np.searchsorted(self.known, found[places]), len(self.known) - 1)] == found[places]]
        if not len(places):
            return
        row = words.row_of[at]
        first, last = np.searchsorted(row, row[places]), np.searchsorted(row, row[places], "right")
        sums = np.zeros(len(at) + 1, np.int64)
        sums[places + 1] = 1
        np.cumsum(sums, out=sums)
        for length in lengths:
            n = length - size + 1
            lo = np.maximum(places - n + 1, first)
            hi = np.minimum(places, last - n)
            _, starts = _expand(lo, np.maximum(hi + 1, lo))
            starts = np.unique(starts)
            yield length, n, starts[(sums[starts + n] - sums[starts]) >= np.ceil(n * 2 * SIMILARITY / (1 + SIMILARITY) - 1e-9)]
            # documents shorter than the item: all that they have
            whole = np.unique(first[(last - first < n) & (last - first >= SIMILARITY * n)])
            for start in whole:
                yield length, int(np.searchsorted(row, row[start], "right") - start), np.array([start])

    def matches(self, column: pa.Array) -> list[tuple[np.ndarray, ...]]:
        """``row, item, similarity, first word, words`` arrays of every window of a block that matches an item."""
        words = W.cut(column, W.PLAIN)
        hashes, out = words.hashes(), []
        for size in range(1, SIZE + 1):
            lengths = [n for n in self.classes if min(n, SIZE) == size]
            if not lengths:
                continue
            at, found = W.windows(hashes, words.rows, size)
            for length, n, starts in self._windows(words, size, at, found, lengths):
                for k in range(0, len(starts), SLICE):
                    part = starts[k : k + SLICE]
                    lists = found[part[:, None] + np.arange(n)]
                    which, item = self._candidates(length, simhash(lists))
                    if not len(which):
                        continue
                    pair, place = _expand(self.bounds[item], self.bounds[item + 1])
                    own = np.repeat(np.arange(len(which)), n)
                    alike = similarity(own, lists[which].ravel(), pair, self.flat[place], len(which))
                    good = alike >= SIMILARITY
                    begin = at[part[which[good]]]
                    row = words.row_of[begin]
                    out.append((row, item[good], alike[good], begin - words.rows[row], np.full(len(row), n + size - 1)))
        return out


def item_blocks(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> Iterator[Items]:
    """The benchmark in blocks of at most some ``BENCHMARK_BYTES``, by a hash of the text."""
    rows = benchmark.select(F.col(key).alias("id"), F.col(text).alias("text")).filter("text IS NOT NULL")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    n = -(-2 * total // BENCHMARK_BYTES) if total > BENCHMARK_BYTES else 1
    for k in range(n):
        part = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == k)
        found = part.collect()  # bounded: the table's size was measured, and its parts follow
        yield Items([r["id"] for r in found], [r["text"] for r in found])


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """One row per document with a match: its best item (most similar, then smallest id), the similarity, the first
    such window's place and length in words, and the number of (different) items it matches."""
    kind, item_kind = docs.schema[key].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    schema = f"`{key}` {kind}, `{item}` {item_kind}, similarity double, start long, n_words long, n_items long"
    spark = docs.sparkSession
    found = []
    for items in item_blocks(benchmark, item):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for block in W.blocks(batches, text):
                out = items.matches(block.column(text))
                if not out:
                    continue
                row, which, alike, start, n = (np.concatenate(c) for c in zip(*out, strict=True))
                order = np.lexsort((start, which, -alike, row))
                row, which, alike, start, n = (c[order] for c in (row, which, alike, start, n))
                head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                pairs = np.unique(row * len(items.ids) + which) // len(items.ids)
                counts = np.bincount(pairs, minlength=len(block))[row[head]]
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column(key).take(pa.array(row[head])), pa.array([items.ids[i] for i in which[head]]),
                        pa.array(alike[head]), pa.array(start[head]), pa.array(n[head]), pa.array(counts),
                    ],
                    [key, item, "similarity", "start", "n_words", "n_items"],
                )

        if items.ids:
            found.append(docs.select(key, text).mapInArrow(run, schema))
    if not found:
        return spark.createDataFrame([], schema)
    best = F.struct(-F.col("similarity"), F.col(item).isNull(), F.col(item), F.col("start"), F.col("n_words"))
    rows = reduce(DataFrame.union, found).groupBy(key).agg(F.min(best).alias("best"), F.sum("n_items").alias("n_items"))
    return rows.select(
        key, f"best.{item}", (-F.col("best.col1")).alias("similarity"), "best.start", "best.n_words", "n_items"
    )


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id") -> DataFrame:
    """The rows of ``docs`` that match no item, with all their columns and without a shuffle."""
    for items in item_blocks(benchmark, item):
        if not items.ids:
            continue
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for block in W.blocks(batches, text):
                keep = np.ones(len(block), bool)
                for row, *_ in shared.value.matches(block.column(text)):
                    keep[row] = False
                yield block.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
