"""MinHash near-duplicates with odd sketches.

A document's set is its distinct ``size``-word shingles (A-Z in lower case). Documents link if their sets
have a Jaccard similarity of at least ``PERCENT`` in a hundred; a component is what links reach.

1. Sketch: 200 MinHash values make 40 bands of 5, so two sets of similarity 0.8 share no band with a chance of
   (1 - 0.8**5)**40 < 2e-7. The same values, hashed to 512 bits by parity, are the odd sketch: the number of
   bits that differ between two sketches tells how many values differ.
2. Documents with equal sets are one class, and each class is a node with a number of its own; only one row of it goes on.
   Classes that share an id are linked from the start.
3. Stars: each bucket of a band compares its members with one leader, so pairs stay in proportion to
   members. A pair whose odd sketches are farther apart than those of similarity ``SKETCH_FLOOR`` is dropped
   (five standard errors below the limit); all others are confirmed on the full sets.
4. A second round of stars takes other leaders for buckets that still hold several components.
5. Rest: in buckets that still do, every member outside the bucket's main component is held against all members
   of other components, in chunks of sketches and sets of short hashes, many to a bucket. Only likely links leave a chunk, to
   be confirmed on the full sets too. No cap: a pair in a bucket is either inside one component or has been compared.

Null or empty texts have an empty set, link with nothing and stay. A null id is in no component and stays.
Rows that share an id have the same component, with all that any of their texts links with. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import words as W
from tidewatch.llm.components import components
from tidewatch.session import stage

SIZE, PERCENT = 4, 80
BANDS, ROWS = 40, 5
BITS = 512
#: Similarity below which a pair's odd sketches rule it out.
SKETCH_FLOOR = 0.63
#: Rounds of stars before the rest is compared in chunks.
STARS = 2
#: Members of a chunk.
CHUNK = 256
#: Shingles hashed at a time, so that they stay in the processor's cache.
CACHED = 1 << 15

_VALUES = BANDS * ROWS
_RANDOM = np.random.default_rng(20240229)
_FACTORS = _RANDOM.integers(0, 1 << 63, _VALUES, np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _RANDOM.integers(0, 1 << 63, _VALUES, np.uint64)


def max_differing_bits(similarity: float) -> int:
    """Bits expected to differ between odd sketches of two sets of that similarity."""
    values = 2 * _VALUES * (1 - similarity)
    return int(BITS / 2 * (1 - (1 - 2 / BITS) ** values))


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of a block, by row and hash."""
    rows, hashes = W.shingles(W.cut(column, W.LOWER), size)
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def min_hashes(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash values of each (non-empty) slice of ``hashes``."""
    out = np.empty((len(bounds) - 1, _VALUES), np.uint64)
    at = 0
    while at < len(out):
        upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + CACHED, "right")) - 1)
        part, cuts = hashes[bounds[at] : bounds[upto]], bounds[at:upto] - bounds[at]
        values = np.empty_like(part)
        for i in range(_VALUES):
            np.multiply(part, _FACTORS[i], out=values)
            values += _TERMS[i]
            out[at:upto, i] = np.minimum.reduceat(values, cuts)
        at = upto
    return out


def odd_sketches(values: np.ndarray) -> np.ndarray:
    """512 parities of each row of MinHash values, as eight whole numbers."""
    bits = W.mix(values + np.arange(_VALUES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 9)
    cells = (np.arange(len(values))[:, None] * BITS + bits.astype(np.int64)).ravel()
    odd = (np.bincount(cells, minlength=len(values) * BITS) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(-1, BITS), axis=1).view(np.int64)


def _lists(values: np.ndarray) -> pa.Array:
    """Rows of whole numbers as lists."""
    flat = np.ascontiguousarray(values).view(np.int64).ravel()
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), pa.array(flat))


def _marked(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("mark"))


def sketches(docs: DataFrame, key: str, text: str, size: int = SIZE) -> DataFrame:
    """``id, mark, n_shingles, set_a, set_b, bands, odd`` of every row; bands and odd are null for an empty set.

    ``mark`` is a hash of the text, which tells texts of one id apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in W.blocks(batches, "text"):
            rows, hashes = shingle_sets(block.column("text"), size)
            counts = np.bincount(rows, minlength=len(block))
            filled = np.flatnonzero(counts)
            bounds = np.concatenate([[0], np.cumsum(counts[filled])])
            values = min_hashes(hashes, bounds)
            band = values.reshape(len(filled), BANDS, ROWS) * _FACTORS[:ROWS]
            band = W.mix(band.sum(axis=2, dtype=np.uint64) + _TERMS[:BANDS])
            lists = [_lists(band), _lists(odd_sketches(values))]
            place = np.full(len(block), -1)
            place[filled] = np.arange(len(filled))
            where = pa.array(place, mask=place < 0)
            sums = []
            for seed in (0, 1):
                total = np.zeros(len(block), np.uint64)
                if len(filled):
                    total[filled] = np.add.reduceat(W.mix(hashes + _TERMS[seed]), bounds[:-1])
                sums.append(pa.array(total.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), block.column("mark"), pa.array(counts.astype(np.int64)), *sums, *(x.take(where) for x in lists)],
                ["id", "mark", "n_shingles", "set_a", "set_b", "bands", "odd"],
            )

    kind = docs.schema[key].dataType.simpleString()
    fields = "mark long, n_shingles long, set_a long, set_b long, bands array<long>, odd array<long>"
    return _marked(docs, key, text).mapInArrow(run, f"id {kind}, {fields}")


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; ``texts`` is ``id, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in W.blocks(batches, "text_a", W.BLOCK_BYTES // 2):
            (row_a, in_a), (row_b, in_b) = (shingle_sets(block.column(c), size) for c in ("text_a", "text_b"))
            rows, hashes = np.concatenate([row_a, row_b]), np.concatenate([in_a, in_b])
            order = np.lexsort((hashes, rows))
            rows, hashes = rows[order], hashes[order]
            common = np.bincount(rows[1:][(rows[1:] == rows[:-1]) & (hashes[1:] == hashes[:-1])], minlength=len(block))
            union = np.bincount(rows, minlength=len(block)) - common
            linked = (100 * common >= PERCENT * union) & (common > 0)
            yield block.select(["a", "b"]).filter(pa.array(linked))

    kind = texts.schema["id"].dataType.simpleString()
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"
    )
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, f"a {kind}, b {kind}")


def _differing(a: str, b: str):
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(BITS // 64)), F.lit(0))


def _close(pairs: DataFrame, sketched: DataFrame) -> DataFrame:
    """Pairs whose odd sketches don't rule them out."""
    a = sketched.select(F.col("id").alias("a"), F.col("odd").alias("odd_a"))
    b = sketched.select(F.col("id").alias("b"), F.col("odd").alias("odd_b"))
    near = _differing("odd_a", "odd_b") <= max_differing_bits(SKETCH_FLOOR)
    return pairs.join(a, "a").join(b, "b").filter(near).select("a", "b")


def _open(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``bucket, id, component`` of the buckets that hold several components."""
    if labels is None:
        return members.withColumn("component", F.col("id"))
    named = members.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    several = named.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    return named.join(several.select("bucket"), "bucket")


def _stars(several: DataFrame, round_: int) -> DataFrame:
    """Pairs of a leader and the members of other components; the smallest id leads first, then a random one."""
    rank = F.col("id") if round_ == 0 else F.xxhash64("id", F.lit(round_))
    lead = several.groupBy("bucket").agg(F.min(F.struct(rank.alias("r"), "id", "component")).alias("lead"))
    led = several.join(lead, "bucket").filter("component <> lead.component")
    return led.select(F.least("id", "lead.id").alias("a"), F.greatest("id", "lead.id").alias("b")).distinct()


def _hash_sets(texts: DataFrame, size: int) -> DataFrame:
    """``id, own``: the upper 32 bits of the hashes of each text's shingles, sorted, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in W.blocks(batches, "text"):
            rows, hashes = shingle_sets(block.column("text"), size)
            cuts = np.searchsorted(rows, np.arange(len(block) + 1))
            short = (hashes >> np.uint64(32)).astype(np.uint32)
            own = [short[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([block.column("id"), pa.array(own, pa.binary())], ["id", "own"])

    return texts.mapInArrow(run, f"id {texts.schema['id'].dataType.simpleString()}, own binary")


def _likely(few: dict, everyone: dict, bucket: int, main: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in both chunks of the pairs to be confirmed.

    Left out are pairs of one component, pairs whose first common bucket is another one (they are looked at there), pairs of
    two outsiders the other way round, and pairs ruled out by their odd sketches, their sizes or their short hashes.
    """
    outsider = everyone["component"] != main
    wanted = (few["component"][:, None] != everyone["component"]) & ~(outsider & (few["id"][:, None] > everyone["id"]))
    differing = np.zeros(wanted.shape, np.int16)
    for word in range(few["odd"].shape[1]):
        differing += np.bitwise_count(few["odd"][:, word, None] ^ everyone["odd"][None, :, word])
    n, m = few["size"][:, None], everyone["size"]
    wanted &= (differing <= max_differing_bits(SKETCH_FLOOR)) & (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m))
    x, y = np.nonzero(wanted)
    common = few["bands"][x] == everyone["bands"][y]
    here = few["bands"][x, common.argmax(axis=1)] == bucket
    x, y = x[here], y[here]
    linked = np.zeros(len(x), bool)
    for place in np.unique(x):
        at = np.flatnonzero(x == place)
        own, others = few["own"][place], [everyone["own"][k] for k in y[at]]
        sizes = np.array([len(o) for o in others])
        found = np.minimum(np.searchsorted(own, flat := np.concatenate(others)), len(own) - 1)
        shared = np.add.reduceat((own[found] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
        # short hashes of different shingles of a set may be equal: allow for some more such cases than are likely
        shared += 2 + sizes.astype(np.int64) ** 2 // (1 << 30)
        linked[at] = 100 * shared >= PERCENT * (len(own) + sizes - shared)
    return x[linked], y[linked]


def _rest(several: DataFrame, sketched: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """Likely links of members outside their bucket's main component with members of other components."""
    kind = several.schema["id"].dataType.simpleString()
    shares = several.groupBy("bucket", "component").count()
    main = shares.groupBy("bucket").agg(
        F.max_by("component", F.struct("count", "component")).alias("main"), F.sum("count").alias("n")
    )
    sets = stage(_hash_sets(texts.join(several.select("id").distinct(), "id"), size), "hash-sets").dropDuplicates(["id"])
    chunk = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / CHUNK)).alias("chunk")
    members = several.join(main, "bucket").select("bucket", "main", chunk, "id", "component")
    columns = ["id", "component", "odd", "bands", "own"]
    members = members.join(sketched, "id").join(sets, "id").select("bucket", "main", "chunk", *columns)

    def chunks(df: DataFrame, mark: str) -> DataFrame:
        each = [F.collect_list(F.struct(*columns)).alias(mark)]
        return df.groupBy("bucket", "main", "chunk").agg(*each).drop("chunk")

    def side(values: pa.StructArray) -> dict:
        numbers = {c: values.field(c).to_numpy(zero_copy_only=False) for c in ("id", "component")}
        wide = {c: values.field(c).flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1) for c in ("odd", "bands")}
        own = [np.frombuffer(v.as_py(), np.uint32) for v in values.field("own")]
        return {**numbers, "odd": wide["odd"].view(np.uint64), "bands": wide["bands"], "own": own, "size": np.array([len(o) for o in own])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                few, everyone = side(batch.column("few")[i].values), side(batch.column("all")[i].values)
                x, y = _likely(few, everyone, batch.column("bucket")[i].as_py(), batch.column("main")[i].as_py())
                a, b = np.minimum(few["id"][x], everyone["id"][y]), np.maximum(few["id"][x], everyone["id"][y])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    few = chunks(members.filter("component <> main"), "few").drop("main")
    return few.join(chunks(members, "all"), "bucket").mapInArrow(run, f"a {kind}, b {kind}").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """Per row ``key, n_shingles, component_id, kept``; a component keeps its smallest id."""
    sk = stage(sketches(docs, key, text, size), "sketches")
    whole = sk.filter("n_shingles > 0 AND id IS NOT NULL")
    classes = whole.groupBy("set_a", "set_b").agg(F.min("id").alias("id"), F.min_by("mark", "id").alias("mark"))
    # numbered as they are written: each number is read from the staged table ever after
    classes = stage(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    firsts = whole.join(classes.select("id", "mark", "set_a", "set_b", "node"), ["id", "mark", "set_a", "set_b"])
    rows = firsts.select(F.col("node").alias("id"), F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi")
    members = stage(rows.join(shared.select("bucket"), "bucket").distinct(), "buckets")
    ids = members.select("id").distinct()
    sketched = firsts.select(F.col("node").alias("id"), "odd", "bands").join(ids, "id").dropDuplicates(["id"])
    sketched = stage(sketched, "sketched")
    wanted = classes.select("id", "mark", "node").join(ids.withColumnRenamed("id", "node"), "node")
    texts = _marked(docs, key, text).join(wanted, ["id", "mark"]).select(F.col("node").alias("id"), "text")
    texts = stage(texts.dropDuplicates(["id"]), "texts")
    named = whole.select("id", "set_a", "set_b").join(classes.select("set_a", "set_b", "node"), ["set_a", "set_b"])
    named = stage(named.select("id", "node").distinct(), "named")
    same = named.groupBy("id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi")
    same = stage(named.join(same, "id").select(F.col("lo").alias("a"), F.col("node").alias("b")).filter("a < b"), "same-id")

    links, tested, labels = same, None, None
    for round_ in range(STARS + 1):
        several = _open(members, labels)
        if labels is not None:
            several = stage(several, "open")
            if several.isEmpty():
                break
        pairs = _close(_stars(several, round_), sketched) if round_ < STARS else _rest(several, sketched, texts, size)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        found = stage(_confirmed(pairs, texts, size), "confirmed")
        tested = pairs if tested is None else tested.union(pairs)
        links = links.union(found)
        labels = components(links)

    # every node's label, and from the least id of each class the least of each label
    label = F.coalesce("component", "node").alias("label")
    ranked = classes.select("node", "id").join(labels.withColumnRenamed("id", "node"), "node", "left").select("node", "id", label)
    least = ranked.groupBy("label").agg(F.min("id").alias("component"))
    reached = named.join(ranked.select("node", "label"), "node").join(least, "label").select("id", "component").distinct()
    component = F.coalesce("component", "id")
    return (
        sk.select("id", "n_shingles").join(reached, "id", "left")
        .select(
            F.col("id").alias(key), "n_shingles", component.alias("component_id"),
            F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
        )
    )


def firsts(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns.

    Rows without an id are in no component: all of them stay, copies too.
    """
    gone = near_duplicates(docs, key, text, size).filter("NOT kept").select(key).distinct()
    return docs.join(gone, key, "left_anti").select(*docs.columns)
