"""Token counts of a unigram vocabulary, without making the tokens.

An Aho-Corasick automaton lists the vocabulary's matches in a segment by their ends, the longest first; dynamic
programming carries the best score and its number of pieces to each end. A score replaces another if it is strictly
better, so of equal ones the one with the longest last piece wins, which is the tokenizer's rule. A character that is
no piece costs ten below the least score and counts as its UTF-8 bytes. Scores are added in double precision; the
tokenizer's single precision can differ in texts whose scores add up to over 2**24.

No piece crosses the front of a space or a line feed, so a text's best path is the sum of its segments' and each
task keeps the counts of up to a million segments. Null texts count 0, as empty ones do. Rows are counted one by one:
null and repeated ids and extra columns need no rule, an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidewatch.llm import words as W
from tidewatch.llm.vocabulary import CACHE, MARK, MODEL, Vocabulary, segments

#: What an unknown character costs below the least score.
UNKNOWN = 10.0


class Counter:
    """Piece counts by segment; kept up to ``CACHE`` segments."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(vocabulary.scores.values()) - UNKNOWN
        self.known: dict[str, int] = {}

    def segment(self, text: str) -> int:
        """Pieces on the best path through a segment."""
        size = len(text)
        best, count = [0.0] * (size + 1), [0] * (size + 1)
        reached = 0  # ends up to here have their best path

        def unknown(at: int) -> None:
            """The character before ``at`` is no piece: a path over it is the last one to try."""
            score = best[at - 1] + self.unknown
            if count[at] == 0 or score > best[at]:
                best[at], count[at] = score, count[at - 1] + len(text[at - 1].encode())

        single = False
        for end, (length, score) in self.automaton.iter(text):
            end += 1
            while reached < end:
                if reached and not single:
                    unknown(reached)
                reached += 1
                single = False
            total = best[end - length] + score
            if count[end] == 0 or total > best[end]:
                best[end], count[end] = total, count[end - length] + 1
            single = single or length == 1
        while reached <= size:
            if reached and not single:
                unknown(reached)
            reached += 1
            single = False
        return count[size]

    def text(self, text: str) -> int:
        known, total = self.known, 0
        for part in segments(text):
            n = known.get(part)
            if n is None:
                if len(known) >= CACHE:
                    known.clear()
                n = known[part] = self.segment(part)
            total += n
        return total


def count(docs: DataFrame, model: str = MODEL, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``key, n_tokens``."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for block in W.blocks(batches, text):
            counts = [counter.text((t or "").replace(MARK, " ")) for t in block.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([block.column(key), pa.array(counts, pa.int64())], [key, "n_tokens"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_tokens long")
