"""Substring dedup: remove every word that lies in a repeated window of words, but in the first place it stands.

Every window of ``size`` words gets a Rabin-Karp hash of 64 bits; equal hashes are equal windows (at n
windows some n**2 / 2**65 of them are not). A window is repeated if an equal one starts earlier, by
(document id, place). Repeated windows merge into maximal intervals of words, which go.

Three passes of numpy inside Spark tasks, with packed arrays instead of a row for every window:

1. Blocks of documents are hashed. Within a block each hash keeps its first place and the rest are known to
   be repeats at once, so a passage that stands in a third of all documents is shipped once per block.
   Hashes are dealt by their upper bits into parts, as many as the measured text asks for, so that no part grows with the
   table. (A block writes a row for each part it meets: beyond some ten terabytes those rows hold few hashes each.)
2. A part sorts its hashes, finds those of several blocks and names all their places but the first. Places
   are dealt by a hash of their document.
3. The places of a document merge into intervals, which are joined to the documents.

Null or empty texts have no words and no windows. A document with a null id loses nothing and is no source.
Rows that share an id have one space of places: a window at the same place of both is in neither of them
earlier, and a place that goes, goes from all of them. Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import words as W

WINDOW = 20
#: Text whose windows' hashes make one part (some four times as much while it is sorted), and parts of a small table.
PART_BYTES, LEAST_PARTS = 32 << 20, 16

_PARTS = "part int, hashes binary, docs binary, starts binary, ids binary, gone_ids binary, gone_starts binary"
_PLACES = "part int, ids binary, starts binary"


def n_parts(docs: DataFrame, text: str) -> int:
    """Parts of ``PART_BYTES`` of text each, by one sum over the table, so that no group grows with it."""
    size = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    return max(LEAST_PARTS, -(-size // PART_BYTES))


def _slots(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _runs(values: np.ndarray) -> np.ndarray:
    """Places at which a sorted array changes, with 0 and without its length."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, int)


def _zigzag(ids: np.ndarray) -> np.ndarray:
    return (ids.astype(np.uint64) << np.uint64(1)) ^ (ids >> np.int64(63)).astype(np.uint64)


def _unzigzag(coded: np.ndarray) -> np.ndarray:
    return ((coded >> np.uint64(1)) ^ (np.uint64(0) - (coded & np.uint64(1)))).astype(np.int64)


def _hash_block(block: pa.RecordBatch, size: int, parts: int) -> Iterator[tuple]:
    block = block.filter(block.column(0).is_valid())
    ids = block.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(ids, kind="stable")
    ids, words = ids[order], W.cut(block.column(1).take(pa.array(order)))
    at, hashes = W.windows(words.hashes(), words.rows, size)
    if not len(at):
        return
    row = words.row_of[at]
    start = at - words.rows[row]
    by_hash = np.argsort(hashes, kind="stable")
    hashes, row, start = hashes[by_hash], row[by_hash], start[by_hash]
    heads = _runs(hashes)
    first = np.repeat(heads, np.diff(np.append(heads, len(hashes))))
    # rows of one id may tie; such a window is in no other row earlier
    gone = np.flatnonzero((ids[row] != ids[row[first]]) | (start > start[first]))
    gone_row, gone_start = row[gone], start[gone]
    gone_part = gone_row % parts
    by_part = np.lexsort((gone_row, gone_part))
    gone_row, gone_start, gone_part = gone_row[by_part], gone_start[by_part], gone_part[by_part]
    hashes, row, start = hashes[heads], row[heads], start[heads]
    slots = _slots(hashes, parts)
    for part in np.union1d(slots, gone_part):
        a, b = np.searchsorted(slots, [part, part + 1])
        c, d = np.searchsorted(gone_part, [part, part + 1])
        used, index = np.unique(row[a:b], return_inverse=True)
        yield (
            int(part), W.pack(hashes[a:b], True), W.pack(index), W.pack(start[a:b]), W.pack(_zigzag(ids[used])),
            W.pack(_zigzag(ids[gone_row[c:d]])), W.pack(gone_start[c:d]),
        )


def _repeated(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Id and start of all windows of a part that are repeats."""
    col = {name: [v.as_py() for v in table.column(name)] for name in table.column_names if name != "part"}
    ids = [_unzigzag(W.unpack(i))[W.unpack(d).astype(np.int64)] for i, d in zip(col["ids"], col["docs"], strict=True)]
    hashes, ids = np.concatenate([W.unpack(h) for h in col["hashes"]]), np.concatenate(ids)
    starts = np.concatenate([W.unpack(s) for s in col["starts"]]).astype(np.int64)
    order = np.argsort(hashes, kind="stable")
    found = hashes[order]
    again = np.zeros(len(found), bool)
    again[1:] = found[1:] == found[:-1]
    again[:-1] |= again[1:]
    order = order[again]
    hashes, ids, starts = hashes[order], ids[order], starts[order]
    order = np.lexsort((starts, ids, hashes))
    hashes, ids, starts = hashes[order], ids[order], starts[order]
    heads = _runs(hashes)
    first = np.repeat(heads, np.diff(np.append(heads, len(hashes))))
    later = (ids != ids[first]) | (starts != starts[first])
    gone_ids = np.concatenate([ids[later], *(_unzigzag(W.unpack(g)) for g in col["gone_ids"])])
    gone_starts = np.concatenate([starts[later], *(W.unpack(g).astype(np.int64) for g in col["gone_starts"])])
    return gone_ids, gone_starts


def repeated_intervals(docs: DataFrame, size: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, froms, tos``: the maximal intervals of words (ends exclusive) that go, of each document that has any."""
    parts = n_parts(docs, text)
    kind = docs.schema[key].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in W.blocks(batches, text):
            rows = list(_hash_block(block, size, parts))
            if rows:
                columns = [pa.array(c, pa.int32() if not k else pa.binary()) for k, c in enumerate(zip(*rows, strict=True))]
                names = ["part", "hashes", "docs", "starts", "ids", "gone_ids", "gone_starts"]
                yield pa.RecordBatch.from_arrays(columns, names)

    def places(table: pa.Table) -> pa.Table:
        ids, starts = _repeated(table)
        slots = _slots(W.mix(ids.astype(np.uint64)), parts)
        order = np.lexsort((starts, ids, slots))
        ids, starts, slots = ids[order], starts[order], slots[order]
        heads = _runs(slots)
        spans = list(zip(heads, np.append(heads[1:], len(slots)), strict=True))
        return pa.table(
            {
                "part": pa.array(slots[heads], pa.int32()),
                "ids": pa.array([W.pack(_zigzag(ids[a:b])) for a, b in spans], pa.binary()),
                "starts": pa.array([W.pack(starts[a:b]) for a, b in spans], pa.binary()),
            }
        )

    def merged(table: pa.Table) -> pa.Table:
        ids = np.concatenate([_unzigzag(W.unpack(v.as_py())) for v in table.column("ids")])
        starts = np.concatenate([W.unpack(v.as_py()) for v in table.column("starts")]).astype(np.int64)
        order = np.lexsort((starts, ids))
        ids, starts = ids[order], starts[order]
        # a new interval begins with a document, or beyond the end of the window before
        opens = np.concatenate([[True], (ids[1:] != ids[:-1]) | (starts[1:] > starts[:-1] + size)])
        heads = np.flatnonzero(opens)
        tails = np.append(heads[1:], len(ids)) - 1
        ids, froms, tos = ids[heads], starts[heads], starts[tails] + size
        docs_at = np.append(_runs(ids), len(ids)).astype(np.int32)
        return pa.table(
            {
                key: pa.array(ids[docs_at[:-1]]),
                "froms": pa.ListArray.from_arrays(pa.array(docs_at), pa.array(froms)),
                "tos": pa.ListArray.from_arrays(pa.array(docs_at), pa.array(tos)),
            }
        )

    return (
        docs.select(key, text).mapInArrow(hashed, _PARTS)
        .repartition(parts, "part").groupBy("part").applyInArrow(places, _PLACES)
        .repartition(parts, "part").groupBy("part").applyInArrow(merged, f"`{key}` long, froms array<long>, tos array<long>")
        .withColumn(key, F.col(key).cast(kind))
    )


def dedup(docs: DataFrame, size: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``key, n_words, n_removed, kept``: the words that stay, joined by one space."""
    return _rows(docs, size, key, text, "kept string", lambda kept: kept.decode())


def digest(docs: DataFrame, size: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``dedup``, with the SHA-256 of what stays."""
    return _rows(docs, size, key, text, "kept_sha256 string", lambda kept: hashlib.sha256(kept).hexdigest())


def _rows(docs: DataFrame, size: int, key: str, text: str, field: str, of) -> DataFrame:
    kind = docs.schema[key].dataType.simpleString()

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in W.blocks(batches, text):
            n_words, n_removed, kept = [], [], []
            texts, froms, tos = (block.column(c).to_pylist() for c in (text, "froms", "tos"))
            for value, starts, ends in zip(texts, froms, tos, strict=True):
                words = (value or "").encode().split()
                n_words.append(len(words))
                if starts:
                    stay, at = [], 0
                    for a, b in zip(starts, ends, strict=True):
                        stay += words[at:a]
                        at = b
                    words = stay + words[at:]
                n_removed.append(n_words[-1] - len(words))
                kept.append(of(b" ".join(words)))
            yield pa.RecordBatch.from_arrays(
                [block.column(key), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                [key, "n_words", "n_removed", field.split()[0]],
            )

    joined = docs.select(key, text).join(repeated_intervals(docs, size, key, text), key, "left")
    return joined.mapInArrow(cut_out, f"`{key}` {kind}, n_words long, n_removed long, {field}")
