"""MinHash near-duplicates with odd sketches.

A text's set of word shingles gives ``BANDS * ROWS`` MinHash samples. Bands of
them find candidates; all of them together are folded into a bitmap of parities
(an odd sketch), and the population count of two bitmaps' XOR tells how many
samples differ. A second odd sketch folds the whole set: its count never
exceeds the number of shingles that differ, so it rules candidates out for certain.
Candidates that pass both are compared on their full shingle sets.

Texts with the same set are one node throughout, so that a group of copies of
any size costs one signature. A band bucket of more than ``SMALL`` nodes never
emits its pairs: first every node is compared with one hub, then, only where
nodes of several components are left, blocks of sketches are compared inside
tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.llm.components import components
from hitledger.llm.stages import Stages, maybe_broadcast
from hitledger.llm.textbytes import (
    WHITE, byte_table, mix, pieces, span_sums, tidy, window_hashes, word_hashes, word_spans,
)

BANDS, ROWS = 32, 5
SKETCH_BITS, SET_BITS = 512, 2048
SKETCH_WORDS, ALL_WORDS = SKETCH_BITS // 64, (SKETCH_BITS + SET_BITS) // 64
#: Buckets up to this size emit their pairs, at most (SMALL - 1) / 2 for each node.
SMALL = 16
#: Sketches compared at once inside a task: members of a bucket, and those of them that are outside its main component.
BLOCK, MINOR_BLOCK = 512, 1024
#: Ids up to this number (8 bytes each) may be broadcast.
BROADCAST_IDS = 500_000


@dataclass(frozen=True)
class Shingles:
    """Distinct runs of ``words`` words; ``percent``: the least similarity of a link."""

    words: int = 5
    percent: int = 80

    @property
    def most_bits(self) -> int:
        """XOR bits that a pair right at the threshold stays below, but for five standard deviations."""
        k, n, away = BANDS * ROWS, SKETCH_BITS, 1 - self.percent / 100
        spread = math.sqrt(k * away * (1 - away))
        odd = lambda differing: (1 - math.exp(-4 * differing / n)) / 2
        mean, up = odd(k * away), odd(k * away + spread)
        return math.ceil(n * mean + 5 * math.hypot(n * (up - mean), math.sqrt(n * mean * (1 - mean))))


def _row_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    data = byte_table(WHITE)[data]
    starts, ends, first = word_spans(data, offsets)
    hashes = word_hashes(data, starts, ends)
    at, windows = window_hashes(hashes, first, words)
    bounds = np.searchsorted(at, first)
    out = []
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        n = first[i + 1] - first[i]
        if b > a:
            out.append(np.unique(windows[a:b]))
        elif n:
            own = hashes[first[i] : first[i + 1]]
            out.append(mix(span_sums(own, np.zeros(1, np.int64), np.array([n])) + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes (rows, BANDS) of sets that are not empty, and their odd sketches, of samples and of all, as ALL_WORDS words."""
    k = BANDS * ROWS
    steps = mix(np.arange(1, 2 * k + 1, dtype=np.uint64))
    scale, shift = steps[:k] | np.uint64(1), steps[k:]
    values = np.concatenate(sets)
    at = np.cumsum([0] + [len(s) for s in sets])[:-1]
    samples = np.empty((k, len(sets)), np.uint64)
    for j in range(k):
        samples[j] = np.minimum.reduceat(values * scale[j] + shift[j], at)
    samples = np.ascontiguousarray(samples.T)
    bands = mix(span_sums_rows(samples.reshape(len(sets) * BANDS, ROWS))).reshape(len(sets), BANDS)
    rows = np.arange(len(sets))
    sampled = _parities(mix(samples + shift).ravel(), np.repeat(rows, k), len(sets), SKETCH_BITS)
    everything = _parities(mix(values), np.repeat(rows, [len(s) for s in sets]), len(sets), SET_BITS)
    return bands, np.concatenate([sampled, everything], 1)


def _parities(hashes: np.ndarray, row: np.ndarray, rows: int, bits: int) -> np.ndarray:
    """For each row a bitmap of whether an odd number of its hashes falls on a bit."""
    place = (hashes % np.uint64(bits)).astype(np.int64) + row * bits
    parity = np.bincount(place, minlength=rows * bits) & 1
    return np.packbits(parity.astype(np.uint8).reshape(rows, bits), axis=1).view(np.uint64)


def span_sums_rows(matrix: np.ndarray) -> np.ndarray:
    """One hash for each row of a matrix."""
    out = np.zeros(len(matrix), np.uint64)
    for column in matrix.T:
        out = mix(out + column)
    return out


def _lists(matrix: np.ndarray) -> pa.Array:
    rows, width = matrix.shape
    return pa.ListArray.from_arrays(np.arange(0, (rows + 1) * width, width, dtype=np.int32), matrix.view(np.int64).ravel())


SIGNED = "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, sketch array<long>"


def sign(docs: DataFrame, shingles: Shingles) -> DataFrame:
    """``docs`` (doc_id long, text string) with set size, a 128-bit key of the set, band hashes and odd sketch."""
    words = shingles.words

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch, "text"):
                sets = _row_sets(data, offsets, words)
                sizes = np.array([len(s) for s in sets])
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                values = np.concatenate(sets)
                keys = [_sums(mix(values + np.uint64(salt)), bounds).view(np.int64) for salt in (1, 2)]
                full = np.flatnonzero(sizes)
                bands, sketch = np.zeros((len(sets), BANDS), np.uint64), np.zeros((len(sets), ALL_WORDS), np.uint64)
                if len(full):
                    bands[full], sketch[full] = _signatures([sets[i] for i in full])
                yield pa.record_batch(
                    [part.column(0), pa.array(sizes, pa.int64()), *map(pa.array, keys), _lists(bands), _lists(sketch)],
                    names=["doc_id", "n_shingles", "k1", "k2", "bands", "sketch"],
                )

    return docs.select("doc_id", "text").mapInArrow(tidy(docs.sparkSession, rows), SIGNED)


def full_sets(docs: DataFrame, shingles: Shingles) -> DataFrame:
    """(node, items) of ``docs`` (doc_id, text): the whole shingle sets."""
    words = shingles.words

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch, "text"):
                sets = _row_sets(data, offsets, words)
                at = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                items = pa.ListArray.from_arrays(at, np.concatenate(sets).view(np.int64))
                yield pa.record_batch([part.column(0), items], names=["node", "items"])

    return docs.select("doc_id", "text").mapInArrow(tidy(docs.sparkSession, rows), "node long, items array<long>")


def _plausible(pairs: DataFrame, signed: DataFrame, shingles: Shingles) -> DataFrame:
    """The pairs (a, b) whose set sizes and odd sketches allow a link."""
    for side in ("a", "b"):
        own = signed.select(F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}"))
        pairs = pairs.join(own, side)
    differing = lambda a, b: sum((F.bit_count(F.col("s_a")[i].bitwiseXOR(F.col("s_b")[i])) for i in range(a, b)), F.lit(0))
    samples, items = differing(0, SKETCH_WORDS), differing(SKETCH_WORDS, ALL_WORDS)
    possible = items * (100 + shingles.percent) <= (F.col("n_a") + F.col("n_b")) * (100 - shingles.percent)
    near = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * shingles.percent
    return pairs.where(near & (samples <= shingles.most_bits) & possible).select("a", "b")


def _confirmed(stages: Stages, docs: DataFrame, pairs: DataFrame, shingles: Shingles) -> DataFrame:
    """Those of ``pairs`` (a table) whose full sets are similar enough."""
    ids = stages.write(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    wanted = docs.select("doc_id", "text").join(maybe_broadcast(ids, BROADCAST_IDS), "doc_id", "left_semi")
    sets = stages.write(full_sets(wanted, shingles), "sets")
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("items").alias(f"i_{side}")), side)
    both = F.size(F.array_intersect("i_a", "i_b"))
    linked = both * 100 >= (F.size("i_a") + F.size("i_b") - both) * shingles.percent
    out = stages.write(pairs.where(linked).select("a", "b").distinct(), "links")
    stages.drop(ids, sets)
    return out


def _block_pairs(members: DataFrame, best: int | None, shingles: Shingles) -> DataFrame:
    """Plausible pairs between different components inside large buckets.

    ``members``: (band, hash, n, hub_label, n_minor, node, label, n_shingles, sketch).
    Every node outside its bucket's main component meets every node of the
    bucket, block by block. A block gives the ``best`` most similar partners of
    each such node, or all (None).
    """
    blocks = lambda count, size: F.ceil(F.col(count) / size).cast("int")
    minor = F.col("label") != F.col("hub_label")
    deal = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), n).cast("int")
    key = ["band", "hash", "i", "j"]
    columns = [*key, "side", "node", "label", "n_shingles", "sketch"]
    all_of = members.withColumns({
        "i": deal(blocks("n", BLOCK), 1), "j": F.explode(F.sequence(F.lit(0), blocks("n_minor", MINOR_BLOCK) - 1)), "side": F.lit(0),
    })
    minors = members.where(minor).withColumns({
        "i": F.explode(F.sequence(F.lit(0), blocks("n", BLOCK) - 1)), "j": deal(blocks("n_minor", MINOR_BLOCK), 2), "side": F.lit(1),
    })
    dealt = all_of.select(columns).union(minors.select(columns)).repartition(*key).sortWithinPartitions(*key, "side", "node")
    most_bits, percent = shingles.most_bits, shingles.percent

    def compare(rows: np.ndarray, sketches: np.ndarray) -> list[tuple[int, int]]:
        split = int(np.searchsorted(rows["side"], 1))
        wide, own = slice(0, split), slice(split, len(rows))
        found = []
        for at in range(own.start, own.stop):
            differ = np.bitwise_count(sketches[wide] ^ sketches[at])
            apart, items = differ[:, :SKETCH_WORDS].sum(1, np.int64), differ[:, SKETCH_WORDS:].sum(1, np.int64)
            sizes, size = rows["n"][wide], rows["n"][at]
            fit = (rows["label"][wide] != rows["label"][at]) & (apart <= most_bits)
            fit &= items * (100 + percent) <= (sizes + size) * (100 - percent)
            fit &= np.minimum(sizes, size) * 100 >= np.maximum(sizes, size) * percent
            hits = np.flatnonzero(fit)
            hits = hits if best is None else hits[np.argsort(items[hits], kind="stable")][:best]
            found += [(min(x, y), max(x, y)) for x, y in ((int(rows["node"][at]), int(rows["node"][h])) for h in hits)]
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            rows, sketches = (np.concatenate([p[x] for p in pending]) for x in (1, 2))
            pending.clear()
            found = sorted(set(compare(rows, sketches)))
            return pa.record_batch([pa.array([p[x] for p in found], pa.int64()) for x in (0, 1)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(x).to_numpy() for x in range(4)], 1)
            rows = np.zeros(len(keys), [("side", "i4"), ("node", "i8"), ("label", "i8"), ("n", "i8")])
            for x, name in enumerate(rows.dtype.names):
                rows[name] = batch.column(4 + x).to_numpy()
            sketches = batch.column(8).flatten().to_numpy().view(np.uint64).reshape(len(keys), -1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if pending and (pending[-1][0] != keys[a]).any():
                    yield flush()
                pending.append((keys[a], rows[a:b], sketches[a:b]))
        if pending:
            yield flush()

    return dealt.mapInArrow(tidy(dealt.sparkSession, run), "a long, b long")


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows (band, hash, n, hub, node, label) of buckets that hold more than one component."""
    spread = rows.groupBy("band", "hash").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    return rows.join(spread.select("band", "hash"), ["band", "hash"]).select("band", "hash", "n", "hub", "node", "label")


def near_duplicates(docs: DataFrame, shingles: Shingles = Shingles()) -> DataFrame:
    """Class of every document: (doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    ``docs`` needs doc_id long and text string; other columns are ignored. Two
    documents are linked when their shingle sets have at least
    ``shingles.percent`` / 100 of their union in common; component_id is the
    smallest doc_id that links lead to, and the document of that id is kept.

    A text that is null or has no word has no shingles, is linked with nothing
    and kept. Equal texts are linked. Rows that repeat a doc_id are one document
    with several texts. A row without doc_id gets the component of its equals
    and is not kept beside them; without equals its component is null and it is
    kept. An empty table gives an empty result.

    Each link is found unless all ``BANDS`` bands miss it: for a pair right at
    0.8 three in a million.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "near-dup")
    docs = docs.select("doc_id", "text")
    signed = stages.write(sign(docs, shingles), "signed")

    key = ["k1", "k2", "n_shingles"]
    classes = stages.write(
        signed.where("n_shingles > 0").groupBy(key).agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies")), "classes"
    )
    nodes = classes.where("node is not null").select(*key, F.col("node").alias("doc_id"))
    heads = stages.write(
        signed.join(nodes, ["doc_id", *key], "left_semi").dropDuplicates(["doc_id", *key]).withColumnRenamed("doc_id", "node"), "heads"
    )

    bands = heads.select("node", F.posexplode("bands").alias("band", "hash"))
    buckets = bands.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("hub")).where("n > 1")
    shared = stages.write(bands.join(buckets, ["band", "hash"]), "shared")

    small = shared.where(f"n <= {SMALL}").groupBy("band", "hash").agg(F.sort_array(F.collect_set("node")).alias("own"))
    small = small.select("own").distinct().select("own", F.posexplode("own").alias("at", "a"))
    small = small.select("a", F.explode(F.expr("slice(own, at + 2, size(own))")).alias("b"))
    star = shared.where(f"n > {SMALL} and node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    tested = stages.write(_plausible(small.union(star).distinct(), heads, shingles), "pairs")
    labels = components(stages, _confirmed(stages, docs, tested, shingles))
    large = shared.where(f"n > {SMALL}").join(labels.withColumnRenamed("component", "label"), "node", "left")
    mixed = stages.write(_mixed(large.withColumn("label", F.coalesce("label", "node"))), "mixed")
    merges = []
    for best in (0, 8, None):
        if mixed.isEmpty():
            break
        main = mixed.groupBy("band", "hash").agg(
            F.min(F.when(F.col("node") == F.col("hub"), F.col("label"))).alias("hub_label"),
            F.min_by("node", F.struct(F.xxhash64("node"), "node")).alias("other"),
        )
        rows = mixed.join(main, ["band", "hash"])
        if best == 0:  # one more hub, which spares most of what is left
            fresh = rows.where("node <> other").select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
            fresh = _plausible(fresh, heads, shingles)
        else:
            minors = rows.where("label <> hub_label").groupBy("band", "hash").agg(F.count(F.lit(1)).alias("n_minor"))
            members = rows.join(minors, ["band", "hash"]).join(heads.select("node", "n_shingles", "sketch"), "node")
            fresh = _block_pairs(members, best, shingles).distinct()
        fresh = stages.write(fresh.join(tested, ["a", "b"], "left_anti"), "pairs")
        if fresh.isEmpty():
            continue
        tested = tested.union(fresh)
        # Components, not nodes, are linked from here on, and only buckets that are still mixed go on.
        found, of = _confirmed(stages, docs, fresh, shingles), mixed.select("node", "label").distinct()
        for side in ("a", "b"):
            found = found.join(of.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}")), side)
        merge = components(stages, found.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")))
        merge = merge.select(F.col("node").alias("label"), F.col("component").alias("merged"))
        merges.append(merge)
        now = mixed.join(merge, "label", "left").withColumn("label", F.coalesce("merged", "label")).drop("merged")
        mixed = stages.write(_mixed(now), "mixed")

    roots = classes.join(labels, "node", "left").select(*key, F.coalesce("component", "node").alias("label"))
    for merge in merges:
        roots = roots.join(merge, "label", "left").select(*key, F.coalesce("merged", "label").alias("label"))
    roots = roots.withColumnRenamed("label", "component_id")
    rows = signed.select("doc_id", *key)
    with_class = rows.where("n_shingles > 0").join(roots, key)
    alone = rows.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    both = with_class.unionByName(alone)
    return both.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, shingles: Shingles = Shingles()) -> DataFrame:
    """``docs`` without the documents that :func:`near_duplicates` does not keep.

    Rows without doc_id stay. Of rows that repeat a kept doc_id and are equal in
    every column one stays; with different texts they are one document, and all stay.
    """
    classes = near_duplicates(docs, shingles)
    stages = Stages(docs.sparkSession, "near-dup-drop")
    classes = stages.write(classes.select("doc_id", "kept"), "classes")
    dropped = classes.where("not kept").select("doc_id").distinct()
    left = docs.join(maybe_broadcast(dropped, BROADCAST_IDS), "doc_id", "left_anti").select(docs.columns)
    repeated = classes.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    repeated = stages.write(repeated, "repeated")
    if repeated.isEmpty():
        return left
    repeated = maybe_broadcast(repeated, BROADCAST_IDS)
    once = left.join(repeated, "doc_id", "left_anti").select(docs.columns)
    return once.union(left.join(repeated, "doc_id", "left_semi").select(docs.columns).dropDuplicates())
