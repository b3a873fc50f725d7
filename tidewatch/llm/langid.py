"""Language identification by bit-sliced Bloom filters of letter n-grams.

Fitting. Runs of letters, in lower case and with a space at both ends, give n-grams of two to four characters. Spark counts them by
language over all labelled rows. An n-gram belongs to a language if it makes up at least ``MIN_RATE`` of the language's n-grams of
its size and if its rate there is at least ``SHARE`` of the highest rate anywhere, so some belong to several languages and chance
ones (names, quotations, junk) to none. ``MIN_RATE`` bounds the n-grams of a language, whatever the corpus: no more than
``len(SIZES) / MIN_RATE``. Each language has a Bloom filter over the same slots; the filters are stored as slices, so that a slot
is one mask with a bit for each language, and Spark makes the slices by an or over the n-grams of a slot.

Prediction. The masks of an n-gram's ``PROBES`` slots, and-ed, are all languages that contain it. Set bits are counted per language
over the n-grams of a text, and the share of n-grams that a filter of that fill lets through by mistake is taken out:
``(hits / n - f) / (1 - f)``. The language with the highest corrected share wins, the first by name if several have it; the share is
the score.

A null text, or one without a letter, is ``und`` with score 0, and so is every text if nothing was learned. Rows without id, text or
label teach nothing; a null id is not held out. Repeated rows count as often as they stand there. Very long texts are read whole, a
few million characters at a time. Any number of languages works: 63 share a plane of masks. Other columns pass ``detect`` unread.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidewatch.llm import words as W
from tidewatch.session import stage, temporary_stages

SIZES = (2, 3, 4)
MIN_RATE, SHARE = 1e-5, 0.3
#: Slots for each n-gram of the largest filter, and slots that an n-gram sets.
ROOM, PROBES = 16, 4
#: Languages of a plane (a signed long holds the mask), and characters that are cut into n-grams at a time.
PLANE, PIECE = 63, 1 << 18
UNKNOWN = "und"

_NO_LETTER = re.compile(r"[\W\d_]")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


class Grams:
    """Cuts texts into hashes of n-grams."""

    def __init__(self):
        self.letters = _letters()

    def of(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per size the hashes of all n-grams of some texts, and the places among them at which each text begins, with the end.

        Equal hashes stand for equal n-grams; the lowest two bits are the size.
        """
        lowered = [t.lower() for t in texts]
        points = np.frombuffer(" ".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = self.letters[points]
        # a space stands in front of every run of letters and after it; other characters are not there
        keep = letter.copy()
        keep[:-1] |= letter[1:]
        keep[1:] |= letter[:-1]
        at = np.flatnonzero(keep)
        inside = letter[at]
        chars = np.where(inside, points[at], np.uint32(32)).astype(np.uint64)
        ends = np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1)
        begins = np.searchsorted(at, np.concatenate([[1], ends + 1]))
        hashes, places, h, middle = [], [], chars, inside
        for size in range(2, max(SIZES) + 1):
            h = h[:-1] * _BASE + chars[size - 1 :]
            # letters all along, but for a space at either end; of two characters one is a letter
            if size == 2:
                good = inside[:-1] | inside[1:]
            elif size == 3:
                middle = inside[1:-1]
                good = middle
            else:
                middle = middle[:-1] & inside[size - 2 : -1]
                good = middle
            if size not in SIZES:
                continue
            start = np.flatnonzero(good)
            found = h[start]
            found ^= found >> np.uint64(32)
            found *= np.uint64(0xFF51AFD7ED558CCD)
            found ^= found >> np.uint64(29)
            found &= ~np.uint64(3)
            found |= np.uint64(size - 2)
            hashes.append(found)
            # the space in front may be the one after the text before: the second character tells
            places.append(np.searchsorted(start + 1, begins))
        return hashes, places


def _parts(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Rows and their texts; a long text comes in several parts, cut where no letter stands."""
    rows, held, size = [], [], 0
    for row, text in enumerate(texts):
        at = 0
        while text is not None and at < len(text):
            cut = _NO_LETTER.search(text, at + PIECE) if len(text) - at > PIECE else None
            upto = cut.end() if cut else len(text)
            if held and size + upto - at > PIECE:
                yield rows, held
                rows, held, size = [], [], 0
            rows.append(row)
            held.append(text[at:upto])
            size += upto - at
            at = upto
    if held:
        yield rows, held


def _slots(hashes: np.ndarray, m: int) -> list[np.ndarray]:
    """The slots of n-grams among ``m``, a power of two, by two halves of the hash."""
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return [((low + np.uint64(k) * high) & np.uint64(m - 1)).astype(np.int64) for k in range(PROBES)]


@dataclass(frozen=True)
class Model:
    """``planes[p, slot]`` is the mask of languages ``63 p`` and on; ``mistaken[l]`` the share a filter lets through by chance."""

    languages: tuple[str, ...]
    planes: np.ndarray
    mistaken: np.ndarray

    def hits(self, hashes: np.ndarray) -> list[np.ndarray]:
        """Per plane the mask of languages that contain each n-gram."""
        slots = _slots(hashes, self.planes.shape[1])
        out = []
        for plane in self.planes:
            mask = plane[slots[0]]
            for s in slots[1:]:
                mask &= plane[s]
            out.append(mask)
        return out

    def predict(self, texts: list[str | None], grams: Grams) -> tuple[list[str], np.ndarray]:
        n, total = np.zeros(len(texts)), np.zeros((len(texts), len(self.languages)))
        for rows, part in _parts(texts):
            for hashes, places in zip(*grams.of(part), strict=True):
                np.add.at(n, rows, np.diff(places))
                for p, mask in enumerate(self.hits(hashes)):
                    for bit in range(min(PLANE, len(self.languages) - p * PLANE)):
                        has = np.concatenate([[0], np.cumsum((mask & mask.dtype.type(1 << bit)) != 0)])
                        np.add.at(total[:, p * PLANE + bit], rows, np.diff(has[places]))
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        share = (total / np.maximum(n, 1)[:, None] - self.mistaken) / (1 - self.mistaken)
        share = np.clip(share, 0, 1)
        best = share.argmax(axis=1)
        score = np.where(n > 0, share[np.arange(len(texts)), best], 0.0)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), n.tolist(), strict=True)], score


def gram_counts(labelled: DataFrame, text: str = "text", label: str = "lang") -> DataFrame:
    """``label, gram, size, n``: how often each n-gram stands in the texts of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for block in W.blocks(batches, text):
            codes = block.column(1).dictionary_encode()
            label_of, names = codes.indices.to_numpy(zero_copy_only=False), codes.dictionary
            found: dict[int, list[np.ndarray]] = {}
            for rows, part in _parts(block.column(0).to_pylist()):
                of = label_of[rows].tolist()
                for code in set(of):
                    hashes, _ = grams.of([t for t, c in zip(part, of, strict=True) if c == code])
                    found.setdefault(code, []).extend(hashes)
            for code, hashes in found.items():
                gram = np.sort(np.concatenate(hashes))
                heads = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.zeros(0, int)
                n = np.diff(np.append(heads, len(gram)))
                gram = gram[heads]
                names_here = pa.array([names[code].as_py()] * len(gram), pa.string())
                columns = [names_here, pa.array(gram.view(np.int64)), pa.array((gram & np.uint64(3)).astype(np.int32) + 2), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, ["label", "gram", "size", "n"])

    made = labelled.select(F.col(text).alias("text"), F.col(label).cast("string").alias("label")).dropna()
    return made.mapInArrow(run, "label string, gram long, size int, n long").groupBy("label", "gram", "size").agg(F.sum("n").alias("n"))


def members(counts: DataFrame) -> DataFrame:
    """``label, gram`` of the n-grams that belong to a language."""
    totals = counts.groupBy("label", "size").agg(F.sum("n").alias("total"))
    rates = counts.join(totals, ["label", "size"]).withColumn("rate", F.col("n") / F.col("total")).filter(F.col("rate") >= MIN_RATE)
    highest = F.max("rate").over(Window.partitionBy("gram"))
    return rates.withColumn("highest", highest).filter(F.col("rate") >= SHARE * F.col("highest")).select("label", "gram")


def fit(labelled: DataFrame, text: str = "text", label: str = "lang") -> Model:
    """Learn from all rows of ``labelled`` that have a text and a label."""
    spark = labelled.sparkSession
    with temporary_stages(spark):
        belong = stage(members(stage(gram_counts(labelled, text, label), "grams")), "members")
        sizes = {r.label: r.n for r in belong.groupBy("label").agg(F.count("*").alias("n")).collect()}
        languages = tuple(sorted(sizes))
        if not languages:
            return Model((), np.zeros((0, 1), np.int64), np.zeros(0))
        m = 1 << int(ROOM * max(sizes.values()) - 1).bit_length()
        order = {name: k for k, name in enumerate(languages)}

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = np.fromiter((order[x] for x in batch.column(0).to_pylist()), np.int64, len(batch))
                for slots in _slots(batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64), m):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(at // PLANE), pa.array(slots), pa.array(np.int64(1) << at % PLANE)], ["plane", "slot", "mask"]
                    )

        slices = (
            belong.mapInArrow(probe, "plane long, slot long, mask long").groupBy("plane", "slot").agg(F.bit_or("mask").alias("mask"))
        ).toArrow()
    kind = next(k for k in (np.int8, np.int16, np.int32, np.int64) if min(len(languages), PLANE) < np.iinfo(k).bits)
    planes = np.zeros((-(-len(languages) // PLANE), m), kind)
    plane, slot, mask = (slices.column(c).to_numpy() for c in ("plane", "slot", "mask"))
    planes[plane, slot] = mask.astype(kind)
    fills = [np.count_nonzero(planes[k // PLANE] >> kind(k % PLANE) & kind(1)) / m for k in range(len(languages))]
    return Model(languages, planes, np.array(fills) ** PROBES)


def detect(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows and columns, with ``lang_pred`` and ``score``; columns that had these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name.lower() not in ("lang_pred", "score")]
    schema = T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for block in W.blocks(batches, text):
            found, score = shared.value.predict(block.column(text).to_pylist(), grams)
            columns = [block.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string()), pa.array(score)], [f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def held_out(key: str = "doc_id"):
    """Rows kept out of learning: the CRC-32 of the id, modulo three, is one."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """Per row ``key, held_out, lang_pred, score``, by a model of the rows that are not held out."""
    model = fit(docs.filter(F.col(key).isNotNull() & ~held_out(key)), text, label)
    found = detect(docs.select(key, text), model, text)
    return found.select(key, held_out(key).alias("held_out"), "lang_pred", "score")
