"""SentencePiece encoding with seeded merge dropout, and its decoding.

Encoding is byte-pair merging by an agenda: pairs of neighbours whose union is a piece wait in order of score, then
place; the first one merges, unless a keyed hash skips it (``dropout`` of the time), and its new neighbours join the
agenda. Short segments take these steps together, in arrays. A skipped pair comes back only as part of a new pair. Without
dropout the result is the tokenizer's own. A run can be repeated anywhere, as the key is made of

- with ``variants=None``: the seed, the whole document id, and the pair's place in the text, so that every occurrence of a
  word has skips of its own. What needs no key is kept by each task: the pairs that a segment tries after given skips, and
  the pieces it ends with. Occurrences look up their first skip among these pairs, and go on from there.
- with a number of ``variants``: the seed, the document's ``variant`` (a hash of its id, below that number), the segment and
  the place inside it. Whole segments are kept, and a segment has no more than that number of results.

Characters that are no piece become their UTF-8 bytes; so does the sign by which pieces write a space. Decoding gives
every text back unchanged. A null text has null ids, an empty one has none. Null ids of documents are a key like
another. Rows are encoded one by one; other columns pass through ``encode`` unread.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewatch.llm import words as W
from tidewatch.llm.vocabulary import CACHE, MODEL, Vocabulary, segments

DROPOUT, SEED, VARIANTS = 0.1, 20240229, 4
#: Segments that are merged step by step together, and the longest of them.
TOGETHER, LONGEST = 1 << 14, 64
_MASK = (1 << 64) - 1
_MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.iinfo(np.int32).max
#: Above the number of steps of a segment of ``LONGEST`` characters, and paths that a task keeps.
_STEPS, PATHS = 1 << 10, 500_000
#: Leading bits of a piece's hash by which it is found.
_LEADING = 18


class Encoder:
    def __init__(self, vocabulary: Vocabulary, dropout: float = DROPOUT, seed: int = SEED, variants: int | None = VARIANTS):
        self.ids, self.bytes_, self.variants = vocabulary.ids, vocabulary.bytes_, variants
        self.rank = {piece: -score for piece, score in vocabulary.scores.items()}
        self.limit, self.seed = int(dropout * (1 << 64)), seed
        self.known: dict[int, dict[str, list[int]]] = {}
        self.table = Table(vocabulary)
        self.paths = Paths()

    def variant(self, key: object) -> int:
        return zlib.crc32(f"{self.seed}:{key}".encode()) % self.variants

    def _key(self, text: str, variant: int) -> int:
        return ((zlib.crc32(text.encode()) << 32 | self.seed & 0xFFFFFFFF) + variant * 0x9E3779B97F4A7C15) & _MASK

    def segment(self, text: str, variant: int) -> list[int]:
        return self._one(text, self._key(text, variant))

    def _one(self, text: str, key: int) -> list[int]:
        size, rank, limit = len(text), self.rank, self.limit
        whole = self.ids.get(text)
        if whole is not None and (not limit or size == 1):
            return [whole]
        end, before = list(range(1, size + 1)), list(range(-1, size - 1))
        agenda = []
        for i in range(size - 1):
            r = rank.get(text[i : i + 2])
            if r is not None:
                agenda.append((r, i, i + 1, i + 2))
        heapq.heapify(agenda)
        while agenda:
            _, left, middle, right = heapq.heappop(agenda)
            if end[left] != middle or end[middle] != right:
                continue  # one of the two has merged since
            if limit:
                h = ((key ^ (left << 40 | middle << 20 | right)) * _MIX[0]) & _MASK
                h = ((h ^ h >> 32) * _MIX[1]) & _MASK
                if h ^ h >> 32 < limit:
                    continue
            end[left], end[middle] = right, -1
            if right < size:
                before[right] = left
                r = rank.get(text[left : end[right]])
                if r is not None:
                    heapq.heappush(agenda, (r, left, right, end[right]))
            if left:
                first = before[left]
                r = rank.get(text[first:right])
                if r is not None:
                    heapq.heappush(agenda, (r, first, left, right))
        out, at = [], 0
        while at < size:
            piece = self.ids.get(text[at : end[at]])
            if piece is None:
                out += [self.bytes_[b] for b in text[at].encode()]
            else:
                out.append(piece)
            at = end[at]
        return out

    def segments(self, texts: list[str], variant: int) -> list[list[int]]:
        """``segment`` of many segments."""
        return self._many(texts, np.fromiter((self._key(t, variant) for t in texts), np.uint64, len(texts)))

    def _many(self, texts: list[str], keys: np.ndarray) -> list[list[int]]:
        """``_one`` of many segments: short ones of like length take each step of their agendas together."""
        out: list[list[int]] = [[]] * len(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(sizes, kind="stable")
        at = 0
        while at < len(order):
            widest = int(sizes[order[min(at + TOGETHER, len(order)) - 1]])
            if sizes[order[at]] > LONGEST:
                out[order[at]] = self._one(texts[order[at]], int(keys[order[at]]))
                at += 1
                continue
            upto = min(at + TOGETHER, int(np.searchsorted(sizes[order], min(max(2 * int(sizes[order[at]]), 8), widest, LONGEST), "right")))
            part = order[at:upto].tolist()
            skips = lambda live, _, places, keys=keys[order[at:upto]]: self._skips(keys[live], places)
            for i, ids in zip(part, self._together([texts[i] for i in part], skips), strict=True):
                out[i] = ids
            at = upto
        return out

    def _together(self, texts: list[str], skips: Callable[[np.ndarray, int, np.ndarray], np.ndarray]) -> Iterator[list[int]]:
        """The pieces of each text, as lists."""
        flat, sizes = self._merged(texts, skips)
        ids, ends = flat.tolist(), np.cumsum(sizes).tolist()
        return (ids[end - size : end] for size, end in zip(sizes.tolist(), ends, strict=True))

    def _merged(self, texts: list[str], skips: Callable[[np.ndarray, int, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of all texts one after the other, and the number of each text's.

        ``skips`` tells of rows, the number of their step and the places of its pairs, which are skipped.
        """
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        n, width = len(texts), int(sizes.max())
        inside = np.arange(width) < sizes[:, None]
        points = np.zeros((n, width), np.uint64)
        points[inside] = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        sums = np.zeros((n, width + 1), np.uint64)
        for k in range(width):
            sums[:, k + 1] = sums[:, k] * _BASE + points[:, k] + np.uint64(1)

        def look(rows: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Rank and id of the piece between places a and b; no rank and -1 if there is none."""
            found = sums[rows, b] - sums[rows, a] * self.table.powers[b - a]
            return self.table.look(found)

        every = np.arange(n)
        starts = np.arange(width)
        end = np.where(inside, starts + 1, -1)
        before = np.broadcast_to(starts - 1, (n, width)).copy()
        rank = np.full((n, width), _NONE, np.int32)
        rows, lefts = np.nonzero(starts + 1 < sizes[:, None])
        rank[rows, lefts] = look(rows, lefts, lefts + 2)[0]
        live, step = every, 0
        while len(live):
            left = rank[live].argmin(axis=1)
            going = rank[live, left] < _NONE
            live, left = live[going], left[going]
            middle = end[live, left]
            right = end[live, middle]
            skipped = skips(live, step, left << 40 | middle << 20 | right)
            step += 1
            rank[live[skipped], left[skipped]] = _NONE
            row, left, middle, right = (x[~skipped] for x in (live, left, middle, right))
            end[row, left], end[row, middle], rank[row, middle], rank[row, left] = right, -1, _NONE, _NONE
            more = right < sizes[row]
            r, a, b = row[more], left[more], right[more]
            before[r, b] = a
            rank[r, a] = look(r, a, end[r, b])[0]
            more = left > 0
            r, b = row[more], right[more]
            first = before[r, left[more]]
            rank[r, first] = look(r, first, b)[0]
        rows, lefts = np.nonzero(end > 0)
        ids = look(rows, lefts, end[rows, lefts])[1]
        strange = np.flatnonzero(ids < 0)
        if len(strange):  # characters that are no piece become bytes
            octets = [texts[r][k].encode() for r, k in zip(rows[strange].tolist(), lefts[strange].tolist(), strict=True)]
            times = np.ones(len(ids), np.int64)
            times[strange] = [len(o) for o in octets]
            ids, rows = np.repeat(ids, times), np.repeat(rows, times)
            ids[ids < 0] = [self.bytes_[o] for some in octets for o in some]
        return ids.astype(np.int32), np.bincount(rows, minlength=n)

    def _skips(self, keys: np.ndarray, places: np.ndarray) -> np.ndarray:
        if not 0 < self.limit <= _MASK:
            return np.full(len(keys), self.limit > 0)
        h = (keys ^ places.astype(np.uint64)) * np.uint64(_MIX[0])
        h = (h ^ h >> np.uint64(32)) * np.uint64(_MIX[1])
        return (h ^ h >> np.uint64(32)) < np.uint64(self.limit)

    def encode_all(self, texts: list[str | None], keys: list) -> list[list[int] | None]:
        """The ids of each text; segments that are not known yet are found for all texts at once."""
        if sum(map(len, self.known.values())) >= CACHE:
            self.known.clear()
        rows = [(self.variant(k), None if t is None else segments(t)) for t, k in zip(texts, keys, strict=True)]
        for variant in {v for v, _ in rows}:
            known = self.known.setdefault(variant, {})
            new = {p for v, parts in rows if v == variant and parts for p in parts if p not in known}
            new = list(new)
            known.update(zip(new, self.segments(new, variant), strict=True))
        out: list[list[int] | None] = []
        for variant, parts in rows:
            if parts is None:
                out.append(None)
                continue
            known, ids = self.known[variant], []
            for part in parts:
                ids += known[part]
            out.append(ids)
        return out

    def _document(self, key: object) -> int:
        return xxhash.xxh64_intdigest(f"{self.seed}:{key}".encode())

    def encode_here(self, text: str, key: object) -> list[int]:
        """The ids of the text of the document ``key``, each occurrence of a segment by itself."""
        out, at, document = [], 0, self._document(key)
        for part in segments(text):
            out += self._one(part, (document + at * int(_BASE)) & _MASK)
            at += len(part)
        return out

    def encode_each(self, texts: list[str | None], keys: list) -> list[list[int] | None]:
        """``encode_here`` of each text, for all texts at once."""
        ids, cuts, _ = self.encode_column(pa.array(texts, pa.string()), keys)
        ids, cuts = ids.tolist(), cuts.tolist()
        return [None if t is None else ids[a:b] for t, a, b in zip(texts, cuts[:-1], cuts[1:], strict=True)]

    def encode_column(self, column: pa.Array, keys: list) -> tuple[np.ndarray, np.ndarray, Segments]:
        """The pieces of all texts, the places at which each text's begin, with the end, and how the texts were cut."""
        cut = Segments.of(column)
        codes, sizes = cut.codes, cut.sizes
        own = np.fromiter((self._document(k) for k in keys), np.uint64, len(keys))[cut.rows] + cut.offsets.astype(np.uint64) * _BASE
        if len(self.paths.skips) >= PATHS:
            self.paths = Paths()
        paths = self.paths
        last = np.full(len(codes), -1)  # the path that each segment ends with
        alone: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # segments, pieces and their numbers, where there is none

        def by_itself(some: np.ndarray, found: list[list[int]]) -> None:
            counts = np.fromiter(map(len, found), np.int64, len(found))
            alone.append((some, np.fromiter((x for ids in found for x in ids), np.int32, int(counts.sum())), counts))

        long = np.flatnonzero(sizes > LONGEST)
        if len(long):
            by_itself(long, [self._one(cut.texts[codes[i]], int(own[i])) for i in long.tolist()])
        path_of = np.fromiter((paths.whole.get(t, -1) for t in cut.texts), np.int64, len(cut.texts))
        new = [i for i in np.flatnonzero(path_of < 0).tolist() if len(cut.texts[i]) <= LONGEST]
        path_of[new] = self._follow([cut.texts[i] for i in new], [()] * len(new))
        paths.whole.update(zip((cut.texts[i] for i in new), path_of[new].tolist(), strict=True))
        left = np.flatnonzero(sizes <= LONGEST)
        path, since = path_of[codes[left]], np.zeros(len(left), np.int64)
        while len(left):
            skip = self._first_skip(path, since, own[left])
            none = skip < 0
            last[left[none]] = path[none]
            left, path, skip = left[~none], path[~none], skip[~none]
            after, example, which, n = np.unique(path * _STEPS + skip, return_index=True, return_inverse=True, return_counts=True)
            known = np.fromiter((paths.after.get(k, -1) for k in after.tolist()), np.int64, len(after))
            new = np.flatnonzero((known < 0) & (n > 1))
            skips = [(*paths.skips[path[e]], int(skip[e])) for e in example[new].tolist()]
            known[new] = self._follow([cut.texts[codes[left[e]]] for e in example[new].tolist()], skips)
            paths.after.update(zip(after[new].tolist(), known[new].tolist(), strict=True))
            path, since = known[which], skip + 1
            some = path < 0  # no other occurrence here took this turn: it goes to its end at once
            if some.any():
                texts = [cut.texts[i] for i in codes[left[some]].tolist()]
                for part, flat, counts in self._many_flat(texts, own[left[some]]):
                    alone.append((left[some][part], flat, counts))
            left, path, since = left[~some], path[~some], since[~some]
        kept, kept_starts, kept_sizes = paths.pieces()
        start, count = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
        by_path = last >= 0
        start[by_path], count[by_path] = kept_starts[last[by_path]], kept_sizes[last[by_path]]
        pool = [kept]
        for some, flat, counts in alone:
            start[some], count[some] = sum(map(len, pool)) + np.cumsum(counts) - counts, counts
            pool.append(flat)
        ends = np.cumsum(count)
        ids = np.concatenate(pool)[np.repeat(start - ends + count, count) + np.arange(int(count.sum()))]
        return ids, np.concatenate([[0], ends])[cut.cuts], cut

    def _many_flat(self, texts: list[str], keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``_one`` of many short segments: some of them, their pieces one after the other, and the number of each one's."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(sizes, kind="stable")
        at = 0
        while at < len(order):
            widest = min(max(2 * int(sizes[order[at]]), 8), LONGEST)
            upto = min(at + TOGETHER, int(np.searchsorted(sizes[order], widest, "right")))
            part = order[at:upto]
            own = keys[part]
            yield part, *self._merged([texts[i] for i in part.tolist()], lambda live, _, places, own=own: self._skips(own[live], places))
            at = upto

    def _first_skip(self, path: np.ndarray, since: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The first step of each path, from step ``since`` on, that the key skips; -1 if there is none."""
        starts, sizes, places = self.paths.arrays()
        n = np.maximum(sizes[path] - since, 0)
        rows = np.repeat(np.arange(len(path)), n)
        steps = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n) + since[rows]
        hits = np.flatnonzero(self._skips(keys[rows], places[starts[path][rows] + steps]))[::-1]
        first = np.full(len(path), -1)
        first[rows[hits]] = steps[hits]  # of equal rows the last one counts
        return first

    def _follow(self, texts: list[str], skips: list[tuple[int, ...]]) -> list[int]:
        """The numbers of new paths: of each text, when just the given steps are skipped."""
        numbers = [0] * len(texts)
        order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
        for at in range(0, len(order), TOGETHER):
            part = order[at : at + TOGETHER]
            pairs = [(r, s) for r, i in enumerate(part) for s in skips[i]]
            gone = np.zeros((len(part), max((s + 1 for _, s in pairs), default=0)), bool)
            if pairs:
                gone[tuple(np.array(pairs).T)] = True
            taken: list[tuple[np.ndarray, np.ndarray]] = []

            def given(live: np.ndarray, step: int, places: np.ndarray, gone=gone, taken=taken) -> np.ndarray:
                taken.append((live, places))
                return gone[live, step] if step < gone.shape[1] else np.zeros(len(live), bool)

            ids, counts = self._merged([texts[i] for i in part], given)
            rows = np.concatenate([r for r, _ in taken]) if taken else np.zeros(0, np.int64)
            places = np.concatenate([p for _, p in taken]) if taken else np.zeros(0, np.int64)
            places = places[np.argsort(rows, kind="stable")]
            numbers_here = self.paths.add(ids, counts, [skips[i] for i in part], np.bincount(rows, minlength=len(part)), places)
            for i, k in zip(part, numbers_here, strict=True):
                numbers[i] = k
        return numbers

    def encode(self, text: str, variant: int) -> list[int]:
        return [x for part in segments(text) for x in self.segment(part, variant)]


@dataclass
class Segments:
    """The segments of a column of texts: the different ones, which of them stands where, and in whose row.

    ``cuts`` are the places at which each row's segments begin, with the end; ``offsets`` are characters of the row before a
    segment, ``sizes`` its characters. ``data`` are the bytes of all rows with the space in front, ``bounds`` those of each row.
    """

    texts: list[str]
    codes: np.ndarray
    rows: np.ndarray
    cuts: np.ndarray
    offsets: np.ndarray
    sizes: np.ndarray
    data: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> Segments:
        """What ``segments`` finds in every text, by bytes: one begins with a row, at and after a line feed, and at the first of some spaces."""
        data, offsets = W.buffers(column)
        filled = offsets[1:] > offsets[:-1]
        data = np.insert(data, offsets[:-1][filled], 0x20)
        bounds = offsets + np.concatenate([[0], np.cumsum(filled)])
        space, feed = data == 0x20, data == 0x0A
        begins = feed.copy()
        begins[1:] |= feed[:-1] | (space[1:] & ~space[:-1])
        begins[bounds[:-1][filled]] = True
        at = np.flatnonzero(begins)
        ends = np.append(at, len(data))
        listed = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data))
        coded = listed.dictionary_encode()
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        cuts = np.searchsorted(at, bounds)
        rows = np.repeat(np.arange(len(column)), np.diff(cuts))
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        return cls(coded.dictionary.to_pylist(), codes, rows, cuts, chars[at] - chars[bounds[rows]], np.diff(chars[ends]), data, bounds)


class Paths:
    """The steps that segments take, by the skips among them; nothing here depends on a key."""

    def __init__(self):
        self.whole: dict[str, int] = {}  # of a segment, without skips
        self.after: dict[int, int] = {}  # of a path and the step skipped in it
        self.skips: list[tuple[int, ...]] = []
        self.ids, self.counts, self.found = np.zeros(0, np.int32), np.zeros(0, np.int64), []
        self.sizes = self.places = np.zeros(0, np.int64)
        self.new: list[tuple[np.ndarray, np.ndarray]] = []
        self.starts = self.sizes

    def add(self, ids: np.ndarray, counts: np.ndarray, skips: list[tuple[int, ...]], sizes: np.ndarray, places: np.ndarray) -> range:
        """Paths that end with ``ids``, ``counts`` of them each, after ``sizes`` steps at ``places``."""
        self.found.append((ids, counts))
        self.skips += skips
        self.new.append((sizes, places))
        return range(len(self.skips) - len(skips), len(self.skips))

    def pieces(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pieces of all paths one after the other; where each path's begin, and how many they are."""
        if self.found:
            self.ids = np.concatenate([self.ids, *(i for i, _ in self.found)])
            self.counts = np.concatenate([self.counts, *(c for _, c in self.found)])
            self.found = []
        return self.ids, np.cumsum(self.counts) - self.counts, self.counts

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.new:
            self.sizes = np.concatenate([self.sizes, *(s for s, _ in self.new)])
            self.places = np.concatenate([self.places, *(p for _, p in self.new)])
            self.starts, self.new = np.cumsum(self.sizes) - self.sizes, []
        return self.starts, self.sizes, self.places


class Table:
    """Pieces by the hash of their characters: a polynomial modulo 2**64, so that of a part follows from prefixes."""

    def __init__(self, vocabulary: Vocabulary):
        pieces = list(vocabulary.ids)
        hashes = np.zeros(len(pieces), np.uint64)
        for i, piece in enumerate(pieces):
            h = 0
            for c in piece:
                h = (h * int(_BASE) + ord(c) + 1) & _MASK
            hashes[i] = h
        hashes *= np.uint64(_MIX[0])  # one to one; spreads the leading bits
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two pieces have one hash")
        ranks = np.unique([-vocabulary.scores[p] for p in pieces], return_inverse=True)[1]  # in the order of scores, ties alike
        self.ranks = np.append(ranks.astype(np.int32)[order], np.int32(_NONE))
        self.ids = np.append(np.array([vocabulary.ids[p] for p in pieces])[order], -1)
        # where the hashes with the same leading bits begin
        self.first = np.searchsorted(self.hashes, np.arange(1 << _LEADING, dtype=np.uint64) << np.uint64(64 - _LEADING))
        self.hashes = np.append(self.hashes, np.uint64(_MASK))
        self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(LONGEST, _BASE)]))

    def look(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes = hashes * np.uint64(_MIX[0])
        at = self.first[hashes >> np.uint64(64 - _LEADING)]
        behind = np.flatnonzero(self.hashes[at] < hashes)
        while len(behind):  # a few steps inside a bucket
            at[behind] += 1
            behind = behind[self.hashes[at[behind]] < hashes[behind]]
        at = np.where(self.hashes[at] == hashes, at, len(self.hashes) - 1)
        return self.ranks[at], self.ids[at]


class Decoder:
    """Pieces and bytes by id, joined by whole columns of ids."""

    def __init__(self, vocabulary: Vocabulary):
        octets = {i: bytes([b]) for b, i in enumerate(vocabulary.bytes_)}
        self.table = [octets.get(i, piece.encode()) for i, piece in enumerate(vocabulary.pieces)]
        self.sizes = np.fromiter(map(len, self.table), np.int64, len(self.table))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(self.table), np.uint8)

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ``ids``, without the space that encoding puts in front."""
        table = self.table
        return b"".join([table[i] for i in ids])[1:].decode()

    def returns(self, ids: np.ndarray, cuts: np.ndarray, cut: Segments) -> np.ndarray:
        """Whether each row's ids decode to its text, by the bytes of all rows at once."""
        octets = np.concatenate([[0], np.cumsum(self.sizes[ids])])
        out = np.diff(octets[cuts]) == np.diff(cut.bounds)
        shift = np.repeat(self.starts[ids] - octets[:-1], self.sizes[ids])
        joined = self.data[shift + np.arange(len(shift))]
        if not out.all():  # only rows of the right length can be compared by place
            row = np.repeat(np.arange(len(out)), np.diff(octets[cuts]))
            joined = joined[out[row]]
            data = cut.data[out[np.repeat(np.arange(len(out)), np.diff(cut.bounds))]]
        else:
            data = cut.data
        right = np.flatnonzero(out)
        wrong = np.concatenate([[0], np.cumsum(joined != data)])
        ends = np.cumsum(np.diff(cut.bounds)[right])
        out[right] = wrong[ends] == wrong[ends - np.diff(cut.bounds)[right]]
        return out


def _with(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    names = {f.name.lower() for f in fields}
    return T.StructType([f for f in schema.fields if f.name.lower() not in names] + list(fields))


def _lists(rows: list[list[int] | None]) -> pa.Array:
    return pa.array(rows, pa.list_(pa.int32()))


def encode(
    docs: DataFrame, model: str = MODEL, key: str = "doc_id", text: str = "text",
    dropout: float = DROPOUT, seed: int = SEED, variants: int | None = VARIANTS,
) -> DataFrame:
    """All rows and columns, with ``piece_ids``, ``n_pieces`` and ``lossless`` (the ids decode to the text).

    Columns that had these names are replaced; ``lossless`` is null where the text is.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    made = [
        T.StructField("piece_ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_pieces", T.LongType()),
        T.StructField("lossless", T.BooleanType()),
    ]
    schema = _with(docs.schema, *made)
    kept = [f.name for f in schema.fields[: -len(made)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(shared.value, dropout, seed, variants), Decoder(shared.value)
        for block in W.blocks(batches, text, W.BLOCK_BYTES // 4):
            given, keys = block.column(text), block.column(key).to_pylist()
            if variants is None:
                flat, cuts, cut = encoder.encode_column(given, keys)
                none = given.is_null()
                ids = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(flat), mask=none)
                lossless = pa.array(decoder.returns(flat, cuts, cut), mask=none.to_numpy(zero_copy_only=False))
                counts = pa.array(np.diff(cuts))
            else:
                texts = given.to_pylist()
                lists = encoder.encode_all(texts, keys)
                lossless = pa.array([None if t is None else decoder.decode(i) == t for t, i in zip(texts, lists, strict=True)], pa.bool_())
                counts, ids = pa.array([0 if i is None else len(i) for i in lists], pa.int64()), _lists(lists)
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in kept), ids, counts, lossless], [f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def decode(coded: DataFrame, model: str = MODEL, ids: str = "piece_ids", text: str = "text") -> DataFrame:
    """All rows and columns, with ``text`` made from ``ids``; null ids give null."""
    shared = coded.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    schema = _with(coded.schema, T.StructField(text, T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            texts = [None if i is None else decoder.decode(i) for i in batch.column(ids).to_pylist()]
            columns = [batch.column(f.name) for f in schema.fields[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [f.name for f in schema.fields])

    return coded.mapInArrow(run, schema)
