"""Alignment of two tokenizers: where their tokens meet, which tokens overlap, and in how many documents each pair of ids is linked.

A text, with a space in front, is cut by a byte-level vocabulary (A) and by a SentencePiece model (B). Byte offsets at which tokens of
both end cut it into groups; the union of all token ends cuts it into links, each the overlap of one A token with one B token.

Counts over the corpus come from inverted pair bitmaps.

1. Each task numbers its documents in containers (up to ``CONTAINER`` documents or ``CONTAINER_BYTES`` of text). In a container every
   pair of ids has a bitmap of the documents that hold it linked: plain bits for pairs in many documents, compressed gaps for the
   rest. The bitmaps of a task's blocks are or-merged into the container's. How often a document holds the pair stands in
   multiplicity planes, bit k of the multiplicity of every set bit in plane k. Containers are written once, in ``SHARDS`` pieces.
2. The bits of each pair are counted: set bits are its documents, planes weighted by 2**k its links. Containers share no document, so
   Spark adds the counts up; a pair in a third of all documents is one row per container before that.
3. Counts go back to the postings, piece by piece: every set bit returns the pair's count, times its multiplicity, to its document.
   Pieces of a shard are spread over as many rows of the shard's counts as containers need. A container's pieces add up by document.

Texts that are null or empty, or whose A or B tokens do not join to the text, have no tokens: zeros and an empty digest. Each row is a
document of its own, also where ids are null or repeated; very long texts are cut whole. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.llm import words as W
from tidewatch.llm.vocabulary import MARK, MODEL
from tidewatch.session import stage

BYTES = "/opt/tokenizers/byte_bpe_50k.json"
BLOCK_BYTES = 2 << 20
#: Documents and bytes of text of a container; pieces it is written in; containers that meet one row of counts.
CONTAINER, CONTAINER_BYTES, SHARDS, TOGETHER = 1 << 16, 24 << 20, 64, 32
#: How byte-level vocabularies cut texts before they merge bytes (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass(frozen=True)
class Octets:
    """The bytes of tokens by id, one after the other."""

    starts: np.ndarray
    sizes: np.ndarray
    data: np.ndarray

    @classmethod
    def of(cls, tokens: Sequence[bytes]) -> Octets:
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        return cls(np.cumsum(sizes) - sizes, sizes, np.frombuffer(b"".join(tokens), np.uint8))

    def join(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        shift = np.repeat(self.starts[ids] - (np.cumsum(sizes) - sizes), sizes)
        return self.data[shift + np.arange(len(shift))]


def printable() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: Latin-1's visible ones stand for themselves, others follow 256."""
    visible = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteTokens:
    """Byte-level merging by the ranks of a ``tokenizers`` file; special tokens are plain text."""

    def __init__(self, path: str = BYTES):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        special = {t["content"] for t in content["added_tokens"] if t["special"]}
        signs = printable()
        ids = {bytes(signs[c] for c in t): i for t, i in content["model"]["vocab"].items() if t not in special}
        by_id = [b""] * (1 + max(ids.values()))
        for token, i in ids.items():
            by_id[i] = token
        self.octets = Octets.of(by_id)
        self.encoding = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ids, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encoding.encode_to_numpy(" " + t, disallowed_special=()).astype(np.int64) for t in texts]


class PieceTokens:
    """A SentencePiece model, which puts a space in front of texts by itself."""

    def __init__(self, path: str = MODEL):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        plain = [p.replace(MARK, " ").encode() for p in pieces]
        self.octets = Octets.of([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else plain[i] for i, p in enumerate(pieces)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


@dataclass
class Aligned:
    """The rows of a block: ``rows`` are those with tokens, ``*_cuts`` the places in flat arrays at which each of them begins, and the end.

    ``link_a``, ``link_b`` are the ids of links, ``a_upto``, ``b_upto`` the tokens up to the end of each group.
    """

    n: int
    rows: np.ndarray
    a: np.ndarray
    b: np.ndarray
    a_cuts: np.ndarray
    b_cuts: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    link_cuts: np.ndarray
    a_upto: np.ndarray
    b_upto: np.ndarray
    group_cuts: np.ndarray

    def per_row(self, cuts: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n, np.int64)
        out[self.rows] = np.diff(cuts)
        return out


def _starts(sizes: Sequence[int] | np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64))]).astype(np.int64)


class Aligner:
    def __init__(self, bytes_path: str = BYTES, pieces_path: str = MODEL):
        self.a, self.b = ByteTokens(bytes_path), PieceTokens(pieces_path)
        self.width = len(self.b.octets.sizes)
        self.texts: Digests | None = None

    def align(self, texts: list[str | None]) -> Aligned:
        rows = np.array([i for i, t in enumerate(texts) if t], np.int64)
        given = [texts[i] for i in rows.tolist()]
        a, b = self.a.encode(given), self.b.encode(given)
        octets = [b" " + t.encode() for t in given]
        whole = np.fromiter(
            (
                int(self.a.octets.sizes[x].sum()) == len(o) == int(self.b.octets.sizes[y].sum())
                for x, y, o in zip(a, b, octets, strict=True)
            ),
            bool, len(given),
        )
        for side, ids in ((self.a, a), (self.b, b)):
            left = np.flatnonzero(whole).tolist()
            if left:
                data = np.frombuffer(b"".join([octets[i] for i in left]), np.uint8)
                wrong = np.concatenate([[0], np.cumsum(side.octets.join(np.concatenate([ids[i] for i in left])) != data)])
                cuts = _starts([len(octets[i]) for i in left])
                whole[left] = wrong[cuts[1:]] == wrong[cuts[:-1]]
        left = np.flatnonzero(whole).tolist()
        a, b = [a[i] for i in left], [b[i] for i in left]
        a_cuts, b_cuts, cuts = _starts([len(x) for x in a]), _starts([len(x) for x in b]), _starts([len(octets[i]) for i in left])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        at_a, at_b = np.zeros(cuts[-1] + 1, bool), np.zeros(cuts[-1] + 1, bool)
        at_a[np.cumsum(self.a.octets.sizes[a])] = True
        at_b[np.cumsum(self.b.octets.sizes[b])] = True
        so_a, so_b = np.cumsum(at_a), np.cumsum(at_b)
        ends, both = np.flatnonzero(at_a | at_b), np.flatnonzero(at_a & at_b)
        return Aligned(
            len(texts), rows[left], a, b, a_cuts, b_cuts,
            a[so_a[ends] - at_a[ends]], b[so_b[ends] - at_b[ends]], np.searchsorted(ends, cuts, "right"),
            so_a[both], so_b[both], np.searchsorted(both, cuts, "right"),
        )

    def digests(self, found: Aligned) -> list[str]:
        """Per row the SHA-256 of its groups as text; empty without tokens."""
        if self.texts is None:
            self.texts = Digests(max(len(self.a.octets.sizes), self.width))
        return self.texts.of(found)


class Digests:
    """Groups as text (``a1,a2|b1;a3|b2,b3``), written for a whole block by taking ready strings."""

    SIGNS = ("", ",", "|", ";")

    def __init__(self, size: int):
        self.size = size
        self.strings = pa.array([sign + str(i) for sign in self.SIGNS for i in range(size)], pa.large_string())

    def of(self, found: Aligned) -> list[str]:
        # an A token stands after all B tokens of the groups before its own, a B token after all A tokens up to its group's end
        before_a, before_b = np.concatenate([[0], found.a_upto[:-1]]), np.concatenate([[0], found.b_upto[:-1]])
        n_a, n_b = found.a_upto - before_a, found.b_upto - before_b
        place_a = np.arange(len(found.a)) + np.repeat(before_b, n_a)
        place_b = np.arange(len(found.b)) + np.repeat(found.a_upto, n_b)
        sign_a, sign_b = np.ones(len(found.a), np.int64), np.ones(len(found.b), np.int64)
        sign_a[before_a], sign_b[before_b] = 3, 2
        sign_a[found.a_cuts[:-1]] = 0
        codes = np.empty(len(found.a) + len(found.b), np.int64)
        codes[place_a], codes[place_b] = sign_a * self.size + found.a, sign_b * self.size + found.b
        joined = self.strings.take(pa.array(codes))
        _, offsets, data = joined.buffers()
        offsets = np.frombuffer(offsets, np.int64)[: len(codes) + 1][found.a_cuts + found.b_cuts].tolist()
        view = memoryview(data) if data is not None else memoryview(b"")
        out = [""] * found.n
        for row, x, y in zip(found.rows.tolist(), offsets[:-1], offsets[1:], strict=True):
            out[row] = hashlib.sha256(view[x:y]).hexdigest()
        return out


@dataclass
class Postings:
    """Pairs in order, and for each the documents that hold it (``places[k]:places[k + 1]``) with their multiplicities."""

    pairs: np.ndarray
    places: np.ndarray
    docs: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, pairs: np.ndarray, docs: np.ndarray, n_docs: int) -> Postings:
        """From links: a pair and the number of its document."""
        keys = np.sort(pairs * n_docs + docs)
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        times, keys = np.diff(np.append(heads, len(keys))), keys[heads]
        return cls._listed(keys // n_docs if n_docs else keys, keys % n_docs if n_docs else keys, times)

    @classmethod
    def _listed(cls, pairs: np.ndarray, docs: np.ndarray, times: np.ndarray) -> Postings:
        heads = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, np.int64)
        return cls(pairs[heads], np.append(heads, len(pairs)), docs, times)

    @classmethod
    def merged(cls, parts: list[Postings]) -> Postings:
        """The union of bitmaps over the same container; no two parts hold the same document."""
        pairs = np.concatenate([np.repeat(p.pairs, np.diff(p.places)) for p in parts])
        order = np.argsort(pairs, kind="stable")
        docs, times = (np.concatenate(x)[order] for x in ([p.docs for p in parts], [p.times for p in parts]))
        return cls._listed(pairs[order], docs, times)

    def of_shard(self, shards: np.ndarray, shard: int) -> Postings:
        keep = np.flatnonzero(shards == shard)
        sizes = np.diff(self.places)[keep]
        at = np.repeat(self.places[keep] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return Postings(self.pairs[keep], _starts(sizes), self.docs[at], self.times[at])

    def packed(self, n_docs: int) -> tuple[bytes, bytes, bytes]:
        """Pairs, bitmaps and planes. A pair in more than an eighth of the container has its bits as they are."""
        sizes = np.diff(self.places)
        dense = sizes * 8 > n_docs
        pair_of = np.repeat(np.arange(len(sizes)), sizes)
        bits = np.zeros((int(dense.sum()), n_docs), bool)
        in_dense = dense[pair_of]
        bits[(np.cumsum(dense) - 1)[pair_of[in_dense]], self.docs[in_dense]] = True
        gaps = self.docs.copy()
        gaps[1:] -= self.docs[:-1]
        gaps[self.places[:-1]] = self.docs[self.places[:-1]]
        head = W.pack(np.where(dense, 0, sizes))
        rare = W.pack(gaps[~in_dense])
        plain = pa.compress(np.packbits(bits, axis=1).tobytes(), "zstd", asbytes=True) if dense.any() else b""
        lengths = len(head).to_bytes(8, "little") + len(rare).to_bytes(8, "little")
        top = int(self.times.max(initial=1)).bit_length()
        planes = np.stack([np.packbits((self.times >> k & 1).astype(bool)) for k in range(top)])
        return W.pack(self.pairs, True), lengths + head + rare + plain, top.to_bytes(1, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)

    @classmethod
    def unpacked(cls, pairs: bytes, bitmaps: bytes, planes: bytes, n_docs: int) -> Postings:
        pair = W.unpack(pairs).astype(np.int64)
        a, b = int.from_bytes(bitmaps[:8], "little"), int.from_bytes(bitmaps[8:16], "little")
        sizes = W.unpack(bitmaps[16 : 16 + a]).astype(np.int64)
        gaps = W.unpack(bitmaps[16 + a : 16 + a + b]).astype(np.int64)
        dense = np.flatnonzero(sizes == 0)
        rare_starts = _starts(sizes)[:-1][sizes > 0]
        rare = np.cumsum(gaps)
        rare -= np.repeat(rare[rare_starts] - gaps[rare_starts], sizes[sizes > 0])
        n_bytes = -(-n_docs // 8)
        if len(dense):
            plain = pa.decompress(bitmaps[16 + a + b :], len(dense) * n_bytes, "zstd", asbytes=True)
            rows = np.frombuffer(plain, np.uint8).reshape(len(dense), n_bytes)
            sizes[dense] = np.bitwise_count(rows).sum(axis=1)
            where = np.nonzero(np.unpackbits(rows, axis=1, count=n_docs))[1]
        else:
            where = np.zeros(0, np.int64)
        places = _starts(sizes)
        docs = np.empty(places[-1], np.int64)
        is_dense = np.zeros(len(sizes), bool)
        is_dense[dense] = True
        in_dense = np.repeat(is_dense, sizes)
        docs[in_dense], docs[~in_dense] = where, rare
        n, top = len(docs), planes[0]
        bits = pa.decompress(planes[1:], top * (-(-n // 8)), "zstd", asbytes=True)
        bits = np.unpackbits(np.frombuffer(bits, np.uint8).reshape(top, -1), axis=1, count=n)
        times = (bits.astype(np.int64) << np.arange(top)[:, None]).sum(axis=0)
        return cls(pair, places, docs, times)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Documents and links of each pair: set bits, and planes by their weight."""
        links = np.concatenate([[0], np.cumsum(self.times)])
        return np.diff(self.places), links[self.places[1:]] - links[self.places[:-1]]

    def scores(self, count: np.ndarray, best: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
        """What the pairs return to each document: their counts, and whether they are the best of their A id, for every link."""
        total, top = np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
        sizes = np.diff(self.places)
        np.add.at(total, self.docs, np.repeat(count, sizes) * self.times)
        good = np.repeat(best, sizes)
        np.add.at(top, self.docs[good], self.times[good])
        return total, top


def _shards(pairs: np.ndarray) -> np.ndarray:
    return (W.mix(pairs.astype(np.uint64)) % np.uint64(SHARDS)).astype(np.int64)


_POSTINGS = "block string, shard int, n_docs int, pairs binary, bitmaps binary, planes binary"
_ROW = "doc int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def _index(docs: DataFrame, paths: tuple[str, str], key: str, text: str) -> DataFrame:
    """Written once: a row per container and shard (``shard`` is set), and one per document (``doc`` is)."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"{_POSTINGS}, `{key}` {kind}, {_ROW}"
    names = ["block", "shard", "n_docs", "pairs", "bitmaps", "planes", key, "doc", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*paths)
        types = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), None, pa.int32(), *([pa.int64()] * 4), pa.string()]
        part, number = TaskContext.get().partitionId(), 0
        held: list[Postings] = []
        n_docs = n_bytes = 0

        def written(key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
            whole = Postings.merged(held)
            shards = _shards(whole.pairs)
            for shard in np.unique(shards).tolist():
                piece = whole.of_shard(shards, shard)
                values = [f"{part}-{number}", shard, n_docs, *piece.packed(n_docs)]
                columns = [pa.array([v], t) for v, t in zip(values, types, strict=False)]
                columns += [pa.nulls(1, t or key_type) for t in types[len(values) :]]
                yield pa.RecordBatch.from_arrays(columns, names)

        for block in W.blocks(batches, text, BLOCK_BYTES):
            size = len(block)
            if held and (n_docs + size > CONTAINER or n_bytes > CONTAINER_BYTES):
                yield from written(block.column(key).type)
                held, n_docs, n_bytes, number = [], 0, 0, number + 1
            found = aligner.align(block.column(text).to_pylist())
            row = np.repeat(found.rows, np.diff(found.link_cuts))
            held.append(Postings.of(found.link_a * aligner.width + found.link_b, row + n_docs, n_docs + size))
            columns = [
                pa.array([f"{part}-{number}"] * size), *(pa.nulls(size, t) for t in types[1:6]), block.column(key),
                pa.array(np.arange(n_docs, n_docs + size, dtype=np.int32)),
                *(pa.array(found.per_row(c)) for c in (found.a_cuts, found.b_cuts, found.group_cuts, found.link_cuts)),
                pa.array(aligner.digests(found), pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)
            n_docs += size
            n_bytes += int(W.buffers(block.column(text))[1][-1])
        if held:
            yield from written(block.column(key).type)

    return stage(docs.select(key, text).mapInArrow(run, schema), "alignment")


def _counts(index: DataFrame, width: int) -> DataFrame:
    """``pair, n_docs, n_links, best``: the counts of all pairs; ``best`` has the A id's highest number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                postings = Postings.unpacked(row["pairs"], row["bitmaps"], row["planes"], row["n_docs"])
                columns = [pa.array(x) for x in (postings.pairs, *postings.counts())]
                yield pa.RecordBatch.from_arrays(columns, ["pair", "n_docs", "n_links"])

    pieces = index.filter("shard IS NOT NULL").select("pairs", "bitmaps", "planes", "n_docs")
    counted = pieces.mapInArrow(run, "pair long, n_docs long, n_links long").groupBy("pair").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links")
    )
    of_a = Window.partitionBy(F.expr(f"pair div {width}"))  # no more rows than B has pieces
    return counted.withColumn("best", F.col("n_docs") == F.max("n_docs").over(of_a))


def _returned(index: DataFrame, counts: DataFrame) -> DataFrame:
    """``block, doc, n_best, count_sum``: what the postings return to the documents of each container."""
    salts = 1 + index.filter("shard IS NOT NULL").select("block").distinct().count() // TOGETHER

    def packed(table: pa.Table) -> pa.Table:
        pair, n, best = (table.column(c).to_numpy() for c in ("pair", "n_docs", "best"))
        order = np.argsort(pair)
        values = [W.pack(pair[order], True), W.pack(n[order]), np.packbits(best[order]).tobytes()]
        return pa.table([table.column("shard")[:1], *(pa.array([v], pa.binary()) for v in values)], ["shard", "known", "count", "best"])

    @F.pandas_udf("int")
    def shard_of(pair: pd.Series) -> pd.Series:
        return pd.Series(_shards(pair.to_numpy()))

    ready = (
        counts.select(shard_of("pair").alias("shard"), "pair", "n_docs", "best")
        .groupBy("shard").applyInArrow(packed, "shard int, known binary, count binary, best binary")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    pieces = (
        index.filter("shard IS NOT NULL").select("block", "shard", "n_docs", "pairs", "bitmaps", "planes")
        .withColumn("salt", F.pmod(F.hash("block"), F.lit(salts)))
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                postings = Postings.unpacked(row["pairs"], row["bitmaps"], row["planes"], row["n_docs"])
                known = W.unpack(row["known"]).astype(np.int64)
                at = np.searchsorted(known, postings.pairs)
                best = np.unpackbits(np.frombuffer(row["best"], np.uint8), count=len(known)).astype(bool)
                total, top = postings.scores(W.unpack(row["count"]).astype(np.int64)[at], best[at], row["n_docs"])
                values = [[row["block"]], [W.pack(total)], [W.pack(top)]]
                columns = [pa.array(v, t) for v, t in zip(values, (pa.string(), pa.binary(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["block", "total", "top"])

    def added(table: pa.Table) -> pa.Table:
        total, top = (sum(W.unpack(v.as_py()).astype(np.int64) for v in table.column(c)) for c in ("total", "top"))
        n = len(total)
        names = pa.array([table.column("block")[0].as_py()] * n)
        return pa.table([names, pa.array(np.arange(n, dtype=np.int32)), pa.array(top), pa.array(total)], ["block", "doc", "n_best", "count_sum"])

    met = pieces.join(ready, ["shard", "salt"]).select("block", "n_docs", "pairs", "bitmaps", "planes", "known", "count", "best")
    scored = met.mapInArrow(score, "block string, total binary, top binary")
    return scored.groupBy("block").applyInArrow(added, "block string, doc int, n_best long, count_sum long")


def align(docs: DataFrame, bytes_path: str = BYTES, pieces_path: str = MODEL, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its tokens, groups and links, and what the corpus-wide counts of its linked pairs give."""
    index = _index(docs, (bytes_path, pieces_path), key, text)
    counts = stage(_counts(index, _width(pieces_path)), "pairs")
    found = index.filter("doc IS NOT NULL").join(_returned(index, counts), ["block", "doc"], "left")
    return found.select(
        key, "n_a", "n_b", "n_groups", "n_links",
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")), "groups_sha256",
    )


def _width(pieces_path: str) -> int:
    return len(PieceTokens(pieces_path).octets.sizes)


def pairs(docs: DataFrame, bytes_path: str = BYTES, pieces_path: str = MODEL, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``a_id, b_id, n_docs, n_links, best`` of all pairs of ids that are linked in some document."""
    width = _width(pieces_path)
    counts = _counts(_index(docs, (bytes_path, pieces_path), key, text), width)
    return counts.select(F.expr(f"pair div {width}").alias("a_id"), (F.col("pair") % width).alias("b_id"), "n_docs", "n_links", "best")


def groups(docs: DataFrame, bytes_path: str = BYTES, pieces_path: str = MODEL, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``key, a_ids, b_ids, a_upto, b_upto``: the tokens, and how many of each stand up to the end of each group."""
    kind = docs.schema[key].dataType.simpleString()

    def lists(found: Aligned, flat: np.ndarray, cuts: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(_starts(found.per_row(cuts)).astype(np.int32)), pa.array(flat.astype(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(bytes_path, pieces_path)
        for block in W.blocks(batches, text, BLOCK_BYTES):
            found = aligner.align(block.column(text).to_pylist())
            n_groups = np.diff(found.group_cuts)
            uptos = [upto - np.repeat(cuts[:-1], n_groups) for upto, cuts in ((found.a_upto, found.a_cuts), (found.b_upto, found.b_cuts))]
            columns = [lists(found, found.a, found.a_cuts), lists(found, found.b, found.b_cuts)]
            columns += [lists(found, upto, found.group_cuts) for upto in uptos]
            yield pa.RecordBatch.from_arrays([block.column(key), *columns], [key, "a_ids", "b_ids", "a_upto", "b_upto"])

    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, a_ids array<long>, b_ids array<long>, a_upto array<long>, b_upto array<long>"
    )
