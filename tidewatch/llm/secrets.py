"""Secret scans: three fixed patterns, and a battery of randomness tests under false-discovery control.

Fixed kinds are assignments, access keys and long hexadecimal strings. The method adds ``random`` spans: runs of
``MIN_RANDOM`` or more characters of an encoding's alphabet that fixed spans do not cover and that look drawn at random.
For each run the encoding is inferred from its characters, and three tests ask whether its symbols are

- uniform over the alphabet (chi-squared, scaled by its exact mean and variance, since runs are short),
- switching between the alphabet's halves as often as chance does (runs test),
- free of correlation between neighbours (serial correlation).

Fisher's method joins them to one p-value, which is uniform for random strings and near 0 for words. The power
of the tests grows with length, so the share of false discoveries is controlled for each encoding and class of lengths:
p-values of all documents are counted in ``BINS`` bins; those of at least one half tell how many random strings there
are, and the cut is the smallest p-value (of at least ``FLOOR``) from which on at most ``FDR`` of the strings, and one string
less, are too many; sparse classes are pooled. Only these counts (at most encodings x lengths x bins) reach the driver.

Spans are in code points, ends exclusive. Null texts count as empty and have no spans. Rows are scanned one by
one, so repeated rows and ids, null ids and extra columns need no rule; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import words as W

ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
#: Runs shorter than the least length never count, and a longer run holds at most one match: least lengths may stand here.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGNED = 6
KINDS = ("assign", "access", "hex", "random")

MIN_RANDOM = 20
RUN = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_RANDOM)
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings, the narrowest first: the first that has all characters of a run is its encoding.
ALPHABETS = {
    "hex": DIGITS + "abcdef",
    "HEX": DIGITS + "ABCDEF",
    "base32": UPPER + "234567",
    "base36": DIGITS + LOWER,
    "BASE36": DIGITS + UPPER,
    "base62": DIGITS + UPPER + LOWER,
    "base64": UPPER + LOWER + DIGITS + "+/",
    "base64url": UPPER + LOWER + DIGITS + "-_",
}
_PLACES = {name: {c: i for i, c in enumerate(letters)} for name, letters in ALPHABETS.items()}

BINS, FLOOR, FDR = 100, 0.01, 0.05
#: p-values above one half that a class of lengths needs to stand for itself.
ENOUGH = 20
#: Lengths of a class, and the last class.
LENGTHS, LAST = 8, 15

Span = tuple[str, int, int]


def encoding(run: str) -> str | None:
    """The narrowest encoding of a run; None for digits alone, letters of one case alone, or no alphabet."""
    chars = set(run)
    kinds = sum(bool(chars & set(group)) for group in (DIGITS, LOWER, UPPER))
    if kinds < 2:
        return None
    return next((name for name, places in _PLACES.items() if chars <= places.keys()), None)


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def p_random(run: str, name: str) -> float:
    """The joint p-value of the battery."""
    places, n = [_PLACES[name][c] for c in run], len(run)
    k = len(ALPHABETS[name])
    chi = sum(c * c for c in np.bincount(places).tolist()) * k / n - n
    uniform = math.erfc((chi - (k - 1)) / math.sqrt(2 * (k - 1) * (1 - 1 / n)) / math.sqrt(2)) / 2
    upper = [2 * x >= k for x in places]
    a = sum(upper)
    b = n - a
    if a and b:
        runs, mean = 1 + sum(x != y for x, y in zip(upper, upper[1:], strict=False)), 2 * a * b / n + 1
        variance = (mean - 1) * (mean - 2) / (n - 1)
        switching = _two_sided((runs - mean) / math.sqrt(variance)) if variance > 0 else 1.0
    else:
        switching = 2.0 ** (1 - n)
    middle, variance = (k - 1) / 2, (k * k - 1) / 12
    product = sum((x - middle) * (y - middle) for x, y in zip(places, places[1:], strict=False))
    serial = _two_sided(product / variance / math.sqrt(n - 1))
    half = -sum(math.log(max(p, 1e-300)) for p in (uniform, switching, serial))
    return math.exp(-half) * (1 + half + half * half / 2)


def _scan(column: pa.Array) -> tuple[dict[int, list[Span]], dict[int, list[tuple[int, int, str, int, float]]]]:
    """Fixed spans, and runs ``(start, end, encoding, class of length, p)`` that they do not cover, by row.

    Only words of at least 20 bytes can hold a key or a run, and only texts with ``:`` or ``=`` an assignment.
    """
    words = W.cut(column)
    fixed: dict[int, list[Span]] = defaultdict(list)
    sums = np.concatenate([[0], np.cumsum((words.data == 0x3A) | (words.data == 0x3D))])
    for row in np.flatnonzero(np.diff(sums[words.offsets])).tolist():
        for m in ASSIGN.finditer(column[row].as_py()):
            if m.end(2) - m.start(2) >= MIN_ASSIGNED:
                fixed[row].append(("assign", *m.span()))
    long = np.flatnonzero(words.ends - words.starts >= min(MIN_RANDOM, 20))
    found: dict[int, list[tuple[int, int]]] = defaultdict(list)
    if len(long):
        points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
        rows = words.row_of[long]
        at = points[words.starts[long]] - points[words.offsets[rows]]
        raw = words.data.tobytes()
        for row, start, a, b in zip(*(x.tolist() for x in (rows, at, words.starts[long], words.ends[long])), strict=True):
            word = raw[a:b].decode()
            for kind, pattern in (("access", ACCESS), ("hex", HEX)):
                fixed[row] += ((kind, start + m.start(), start + m.end()) for m in pattern.finditer(word))
            found[row] += ((start, *m.span(), m.group()) for m in RUN.finditer(word))
    runs: dict[int, list[tuple[int, int, str, int, float]]] = defaultdict(list)
    for row, hits in found.items():
        for start, a, b, text in hits:
            body = text.rstrip("=")
            covered = start + a
            for s, e in sorted((s, e) for _, s, e in fixed.get(row, ())):
                if s <= covered:
                    covered = max(covered, e)
            if covered >= start + b:
                continue
            if name := encoding(body):
                size = min(len(body) // LENGTHS, LAST)
                runs[row].append((start + a, start + b, name, size, p_random(body, name)))
    return fixed, runs


def cuts(docs: DataFrame, text: str = "text") -> dict[tuple[str, int], float]:
    """For each encoding and class of lengths the least p-value of a discovery, from the counts over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, int, int], int] = defaultdict(int)
        for block in W.blocks(batches, text):
            for hits in _scan(block.column(text))[1].values():
                for _, _, name, size, p in hits:
                    counts[name, size, min(int(p * BINS), BINS - 1)] += 1
        if counts:
            columns = [pa.array(c) for c in zip(*((*key, n) for key, n in counts.items()), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["name", "size", "bin", "n"])

    rows = docs.select(text).mapInArrow(run, "name string, size long, bin long, n long")
    strata: dict[tuple[str, int], list[int]] = defaultdict(lambda: [0] * BINS)
    for row in rows.groupBy("name", "size", "bin").agg(F.sum("n").alias("n")).collect():  # bounded by the bins
        strata[row["name"], row["size"]][row["bin"]] = row["n"]
    return limits(strata)


def limits(strata: dict[tuple[str, int], list[int]]) -> dict[tuple[str, int], float]:
    """Cuts from the counts of p-values by encoding and class of lengths; none where no discovery is safe.

    ``found`` strings lie at or above a cut, and twice the strings above one half, times what is left above the cut, are random ones: the
    others are false, and one more is taken for false, so that a few word-like strings alone are never discoveries.
    Classes of lengths with fewer than ``ENOUGH`` strings above one half are pooled by encoding.
    """
    cut = {}
    for name in sorted({name for name, _ in strata}):
        pools: list[tuple[list[int], np.ndarray]] = []
        sparse: tuple[list[int], np.ndarray] = ([], np.zeros(BINS, np.int64))
        for size in sorted(s for n, s in strata if n == name):
            bins = np.array(strata[name, size])
            if bins[BINS // 2 :].sum() >= ENOUGH:
                pools.append(([size], bins))
            else:
                sparse = ([*sparse[0], size], sparse[1] + bins)
        if sparse[0]:
            pools.append(sparse)
        for sizes, bins in pools:
            random = bins[BINS // 2 :].sum() / 0.5
            for k in range(round(FLOOR * BINS), BINS):
                found = bins[k:].sum()
                if found - random * (1 - k / BINS) + 1 <= FDR * found:
                    cut.update({(name, size): k / BINS for size in sizes})
                    break
    return cut


def _spans(column: pa.Array, limits: dict[tuple[str, int], float]) -> dict[int, list[Span]]:
    """All spans of each row that has any, by start and kind."""
    fixed, runs = _scan(column)
    for row, hits in runs.items():
        fixed[row] += (("random", a, b) for a, b, name, size, p in hits if p >= limits.get((name, size), 2.0))
    order = {kind: k for k, kind in enumerate(KINDS)}
    return {row: sorted(spans, key=lambda s: (s[1], order[s[0]], s[2])) for row, spans in fixed.items() if spans}


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``key, n_assign, n_access, n_hex, base_sha256, spans, n_random``."""
    found_limits, kind = cuts(docs, text), docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = hashlib.sha256(b"").hexdigest()
        for block in W.blocks(batches, text):
            found = _spans(block.column(text), found_limits)
            counts = {k: np.zeros(len(block), np.int64) for k in KINDS}
            digests, joined = [none] * len(block), [""] * len(block)
            for row, spans in found.items():
                for span in spans:
                    counts[span[0]][row] += 1
                joined[row] = _joined(spans)
                digests[row] = hashlib.sha256(_joined([s for s in spans if s[0] != "random"]).encode()).hexdigest()
            yield pa.RecordBatch.from_arrays(
                [block.column(key), *(pa.array(counts[k]) for k in KINDS[:3]), pa.array(digests), pa.array(joined), pa.array(counts["random"])],
                [key, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"],
            )

    fields = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, {fields}")


def redact(docs: DataFrame, text: str = "text", mask: str = "[SECRET]", chars: str = "n_chars") -> DataFrame:
    """All rows and columns, with each secret (overlapping spans as one) replaced by ``mask``.

    A column ``chars``, if there is one, is counted again where the text changed.
    """
    found_limits = cuts(docs, text)
    has_chars = chars in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in W.blocks(batches, text):
            found = _spans(block.column(text), found_limits)
            if found:
                texts = block.column(text).to_pylist()
                lengths = block.column(chars).to_pylist() if has_chars else []
                for row, spans in found.items():
                    value, out, at = texts[row], [], 0
                    for _, start, end in spans:
                        if start >= at:
                            out += (value[at:start], mask)
                        at = max(at, end)
                    texts[row] = "".join(out) + value[at:]
                    if has_chars:
                        lengths[row] = len(texts[row])
                columns = [
                    pa.array(texts, f.type) if f.name == text else pa.array(lengths, f.type) if has_chars and f.name == chars else block.column(f.name)
                    for f in block.schema
                ]
                block = pa.RecordBatch.from_arrays(columns, schema=block.schema)
            yield block

    return docs.mapInArrow(run, docs.schema)
