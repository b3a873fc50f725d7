"""Quality rules as a short-circuit cascade.

Rules are vectorised tests over blocks of texts. A bounded sample gives each rule's cost (seconds a row)
and selectivity (share of rows it rejects), assuming that rules fail independently; the rule that rejects
most per second goes first, and a later rule sees only the rows that all earlier ones kept. The order
changes the work, never the verdict: a document is kept if no rule rejects it.

Null texts count as empty and have no words; every rule that divides by a number of words or lines is
stated as a product, so an empty text fails ``few_words`` alone. Rows are judged one by one: repeated
rows, null ids and extra columns pass through, and an empty table gives an empty table.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import words as W

#: Rows, and characters of each, of the sample on which costs and selectivities are estimated.
SAMPLE_ROWS, SAMPLE_CHARS = 1_000, 1 << 14
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
#: Bytes of ASCII letters and of characters beyond ASCII.
LETTERS = np.array([chr(b).isalpha() or b >= 128 for b in range(256)])
#: Windows of this many words count as repeats.
REPEAT_WINDOW = 3


def _per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


class Texts:
    """Measures of a block of texts, each made when first asked for."""

    def __init__(self, column: pa.Array):
        self.column = column

    def take(self, rows: np.ndarray) -> Texts:
        return self if len(rows) == len(self.column) else Texts(self.column.take(pa.array(rows)))

    @cached_property
    def words(self) -> W.Words:
        return W.cut(self.column)

    @cached_property
    def n_words(self) -> np.ndarray:
        return self.words.counts

    @cached_property
    def word_chars(self) -> np.ndarray:
        data = self.words.data
        return _per_row(((data & 0xC0) != 0x80) & ~W.SPACE[data], self.words.offsets)

    @cached_property
    def n_symbols(self) -> np.ndarray:
        return _per_row(SYMBOLS[self.words.data], self.words.offsets)

    @cached_property
    def n_letter_words(self) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(LETTERS[self.words.data], dtype=np.int64)])
        return _per_row(sums[self.words.ends] > sums[self.words.starts], self.words.rows)

    @cached_property
    def _lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, start and end of every line that has a word."""
        ends_at = np.flatnonzero(self.words.data == 0x0A)
        offsets = self.words.offsets
        starts = np.sort(np.concatenate([offsets[:-1], ends_at + 1]), kind="stable")
        ends = np.sort(np.concatenate([ends_at, offsets[1:]]), kind="stable")
        rows = np.repeat(np.arange(len(offsets) - 1), _per_row(self.words.data == 0x0A, offsets) + 1)
        filled = np.searchsorted(self.words.starts, starts) < np.searchsorted(self.words.starts, ends)
        return rows[filled], starts[filled], ends[filled]

    @cached_property
    def n_lines(self) -> np.ndarray:
        return np.bincount(self._lines[0], minlength=len(self.column))

    @cached_property
    def n_dup_lines(self) -> np.ndarray:
        rows, starts, ends = self._lines
        found = W.mix(W._sums(self.words.data, starts, ends, 0) + (ends - starts).astype(np.uint64))
        order = np.lexsort((found, rows))
        rows, found = rows[order], found[order]
        again = (rows[1:] == rows[:-1]) & (found[1:] == found[:-1])
        return np.bincount(rows[1:][again], minlength=len(self.column))

    @cached_property
    def n_repeat_words(self) -> np.ndarray:
        rows = self.words.rows
        at, found = W.windows(self.words.hashes(), rows, REPEAT_WINDOW)
        of = self.words.row_of[at]
        key = W.mix(found + W.mix(of.astype(np.uint64)))
        order = np.argsort(key, kind="stable")
        same = (key[order][1:] == key[order][:-1]) & (of[order][1:] == of[order][:-1])
        again = np.zeros(len(at), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        steps = np.zeros(len(self.words.starts) + 1, np.int32)
        np.add.at(steps, at[again], 1)
        np.add.at(steps, at[again] + REPEAT_WINDOW, -1)
        return _per_row(np.cumsum(steps[:-1]) > 0, rows)


@dataclass(frozen=True)
class Rule:
    """``rejects`` tells for each row of a block whether it goes; it must look at each row alone."""

    name: str
    rejects: Callable[[Texts], np.ndarray]


BASE = (
    Rule("few_words", lambda t: t.n_words < 50),
    Rule("repeats", lambda t: 100 * t.n_repeat_words > 50 * t.n_words),
)
#: Thresholds are lenient: prose of any language passes all of them.
EXTRA = (
    Rule("word_length", lambda t: (t.word_chars < 2 * t.n_words) | (t.word_chars > 20 * t.n_words)),
    Rule("symbols", lambda t: t.n_symbols > t.n_words),
    Rule("letters", lambda t: 10 * t.n_letter_words < 6 * t.n_words),
    Rule("duplicate_lines", lambda t: 100 * t.n_dup_lines > 50 * t.n_lines),
)


def cascade(rules: Sequence[Rule], texts: Texts) -> np.ndarray:
    """The places of rows that no rule rejects; each rule sees only what the ones before it kept."""
    kept = np.arange(len(texts.column))
    for rule in rules:
        if not len(kept):
            break
        stays = np.flatnonzero(~rule.rejects(texts))
        kept, texts = kept[stays], texts.take(stays)
    return kept


def estimate(docs: DataFrame, rules: Sequence[Rule], text: str = "text", rows: int = SAMPLE_ROWS) -> list[dict]:
    """Per rule ``name, seconds, seen, rejected`` over the first ``rows`` documents, of up to ``SAMPLE_CHARS`` each.

    The sample is bounded, and only estimates come from it, so the driver measures it.
    """
    sample = docs.select(F.left(text, F.lit(SAMPLE_CHARS)).alias("text")).take(rows)
    column = pa.array([row["text"] for row in sample], pa.string())
    found = []
    for rule in rules:
        begin = time.perf_counter()
        rejected = int(np.count_nonzero(rule.rejects(Texts(column)))) if len(column) else 0
        found.append({"name": rule.name, "seconds": time.perf_counter() - begin, "seen": len(column), "rejected": rejected})
    return found


def ordered(rules: Sequence[Rule], found: list[dict]) -> list[Rule]:
    """Rules by rejected rows per second, the best first; rules of a sample without rows stay as they are."""
    worth = {f["name"]: f["rejected"] / max(f["seconds"], 1e-9) for f in found}
    return sorted(rules, key=lambda rule: -worth[rule.name])


def plan(docs: DataFrame, rules: Sequence[Rule] = BASE + EXTRA, text: str = "text") -> list[Rule]:
    return ordered(rules, estimate(docs, rules, text))


def keep(docs: DataFrame, rules: Sequence[Rule] = BASE + EXTRA, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the cascade keeps, with all their columns."""
    order = plan(docs, rules, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in W.blocks(batches, text):
            yield block.take(pa.array(cascade(order, Texts(block.column(text)))))

    return docs.mapInArrow(run, docs.schema)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, extra: Sequence[Rule] = EXTRA, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, the five measures, ``base_failed`` and ``kept`` of every row; the cascade decides on those the base keeps."""
    order = plan(docs, extra, text)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in W.blocks(batches, text):
            texts = Texts(block.column(text))
            failed = np.logical_or.reduce([rule.rejects(texts) for rule in BASE])
            passed = np.flatnonzero(~failed)
            kept = np.zeros(len(block), bool)
            kept[passed[cascade(order, texts.take(passed))]] = True
            columns = [pa.array(getattr(texts, name).astype(np.int64)) for name in MEASURES]
            yield pa.RecordBatch.from_arrays(
                [block.column(key), *columns, pa.array(failed), pa.array(kept)],
                [key, *MEASURES, "base_failed", "kept"],
            )

    fields = ", ".join(f"{name} long" for name in MEASURES)
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, {fields}, base_failed boolean, kept boolean")
