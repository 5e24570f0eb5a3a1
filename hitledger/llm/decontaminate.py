"""Benchmark decontamination by a broadcast set of normalised test n-grams.

The benchmark's word windows are hashed on the driver and broadcast; every task
slides over its documents' words, looks each window up, and compares the words
themselves on a hit. Documents are never shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.llm.stages import Stages, adds, keeps
from hitledger.llm.textbytes import NOT_WORD, byte_table, pieces, tidy, utf8_column, window_hashes, word_hashes, word_spans

WINDOW = 10
#: Bytes of benchmark text that one broadcast may hold; a larger benchmark is scanned for in several broadcasts.
BROADCAST_BYTES = 64 << 20
#: Slots of the table that tells most windows apart from all test windows by one look.
SLOT_BITS = 20


@dataclass
class Windows:
    """Test windows of one length: sorted hashes, their words, and the items that hold them."""

    hashes: np.ndarray
    slots: np.ndarray
    words: dict[int, dict[bytes, list[str]]]


def _normal(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = utf8_column(column)
    return byte_table(NOT_WORD)[data], offsets


def _words_at(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: int, length: int) -> bytes:
    return b" ".join(data[starts[k] : ends[k]].tobytes() for k in range(at, at + length))


def test_windows(rows: list[tuple[object, str | None]], window: int) -> dict[int, Windows]:
    """Windows by length of items (item_id, text): ``window`` words, or the whole of a shorter item."""
    data, offsets = _normal(pa.array([text for _, text in rows], pa.large_string()))
    starts, ends, first = word_spans(data, offsets)
    hashes = word_hashes(data, starts, ends)
    found: dict[int, dict[int, dict[bytes, set[str]]]] = defaultdict(lambda: defaultdict(lambda: defaultdict(set)))
    counts = np.diff(first)
    for length in sorted({min(int(n), window) for n in counts if n}):
        at, own = window_hashes(hashes, first, length)
        item = np.searchsorted(first, at, "right") - 1
        for a, h, i in zip(at.tolist(), own.tolist(), item.tolist()):
            if length == window or counts[i] == length:
                found[length][h][_words_at(data, starts, ends, a, length)].add(str(rows[i][0]))
    out = {}
    for length, by_hash in found.items():
        keys = np.array(sorted(by_hash), np.uint64)
        slots = np.zeros(1 << SLOT_BITS, bool)
        slots[(keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64)] = True
        out[length] = Windows(keys, slots, {h: {w: sorted(i) for w, i in own.items()} for h, own in by_hash.items()})
    return out


def _piece_hits(data: np.ndarray, offsets: np.ndarray, tests: dict[int, Windows]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[set[str]]]:
    """Of each row: the first word (n + 1 values); of each word: byte span and whether it is hit; of each row: the items."""
    starts, ends, first = word_spans(data, offsets)
    hashes = word_hashes(data, starts, ends)
    hit = np.zeros(len(starts), bool)
    items: list[set[str]] = [set() for _ in range(len(offsets) - 1)]
    for length, known in tests.items():
        at, own = window_hashes(hashes, first, length)
        maybe = np.flatnonzero(known.slots[(own >> np.uint64(64 - SLOT_BITS)).astype(np.int64)])
        place = np.minimum(np.searchsorted(known.hashes, own[maybe]), len(known.hashes) - 1)
        for k in maybe[known.hashes[place] == own[maybe]].tolist():
            a = int(at[k])
            ids = known.words[int(own[k])].get(_words_at(data, starts, ends, a, length))
            if ids:
                hit[a : a + length] = True
                items[int(np.searchsorted(first, a, "right")) - 1].update(ids)
    return first, np.stack([starts, ends]), hit, items


def benchmark_parts(benchmark: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """Items as lists that each stay within BROADCAST_BYTES, each fetched when it is asked for."""
    sized = benchmark.where("text is not null").select("item_id", "text", F.octet_length("text").alias("size"))
    total = sized.agg(F.sum("size")).first()[0] or 0
    n = int(2 * total // BROADCAST_BYTES) + 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        yield [(r.item_id, r.text) for r in sized.where(part == k).select("item_id", "text").collect()]


@adds("n_words", "n_hit", "hit_spans", "hit_items")
def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with what test items they hold.

    Adds ``n_words`` long, ``n_hit`` long, ``hit_spans`` (array of start and end
    bytes of runs of hit words, ends exclusive, in the UTF-8 text) and
    ``hit_items`` (item ids as strings, sorted, distinct). ``docs`` needs a
    column text; its columns of these four names give way. ``benchmark``
    needs item_id and text.

    Words are runs of characters that are no ASCII mark or blank, A-Z counting as
    a-z. A window is ``window`` successive words of an item, or all words of a
    shorter one. Null and empty texts have no words and hit nothing; items
    without words are in no document; equal windows of several items count for
    each. Repeated rows are judged alike; empty tables give no hits.
    """
    spark = docs.sparkSession
    schema = [*docs.schema.names]
    found = docs.withColumns({
        "n_words": F.lit(0).cast("long"), "n_hit": F.lit(0).cast("long"),
        "hit_spans": F.lit(None).cast("array<struct<start:long,end:long>>"), "hit_items": F.lit(None).cast("array<string>"),
    })
    stages = Stages(spark, "contamination")
    for number, rows in enumerate(benchmark_parts(benchmark)):
        if number:  # done with the part before: neither the driver nor a worker holds two
            found = stages.write(found, "part")
            shared.unpersist()
        # As plain values: an instance would be looked up by its class's name, which workers may not know.
        shared = spark.sparkContext.broadcast({k: dict(vars(w)) for k, w in test_windows(rows, window).items()})

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            tests = {k: Windows(**w) for k, w in shared.value.items()}
            table = byte_table(NOT_WORD)
            for batch in batches:
                for part, data, offsets in pieces(batch, "text"):
                    first, spans, hit, items = _piece_hits(table[data], offsets, tests)
                    counts, runs = [], []
                    olds = part.column("hit_spans").to_pylist()
                    old_items = part.column("hit_items").to_pylist()
                    touched = np.concatenate([[0], np.cumsum(hit)])
                    for i in range(part.num_rows):
                        a, b = int(first[i]), int(first[i + 1])
                        own = hit[a:b]
                        if olds[i]:  # of an earlier part of the benchmark
                            own = own.copy()
                            for s in olds[i]:
                                own |= (spans[0][a:b] >= s["start"] + offsets[i]) & (spans[1][a:b] <= s["end"] + offsets[i])
                            counts.append(int(own.sum()))
                        else:
                            counts.append(int(touched[b] - touched[a]))
                        if counts[-1]:
                            edges = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
                            runs.append([
                                {"start": int(spans[0][a + x] - offsets[i]), "end": int(spans[1][a + y - 1] - offsets[i])}
                                for x, y in zip(edges[::2], edges[1::2])
                            ])
                        else:
                            runs.append([])
                        items[i].update(old_items[i] or ())
                    keep = [part.column(name) for name in schema]
                    new = [
                        pa.array(np.diff(first), pa.int64()), pa.array(counts, pa.int64()),
                        pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    ]
                    yield pa.record_batch([*keep, *new], names=[*schema, "n_words", "n_hit", "hit_spans", "hit_items"])

        found = found.mapInArrow(tidy(found.sparkSession, scan), found.schema)
    return found


@keeps("n_words", "n_hit", "hit_spans", "hit_items")
def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without documents that hold a window of a test item; columns as they were."""
    return contamination(docs, benchmark, window).where("n_hit = 0").select(docs.columns)


@keeps("n_words", "n_hit", "hit_spans", "hit_items")
def cut_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the hit words cut out of the text, from the first byte of a run of them to its last."""
    found = contamination(docs, benchmark, window)
    utf8 = F.encode("text", "UTF-8")
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("hit_spans", lambda s: s["end"]))
    ends = F.concat(F.transform("hit_spans", lambda s: s["start"]), F.array(F.octet_length("text").cast("long")))
    left = F.transform(F.arrays_zip(starts.alias("s"), ends.alias("e")), lambda z: F.decode(
        F.substring(utf8, (z["s"] + 1).cast("int"), (z["e"] - z["s"]).cast("int")), "UTF-8"
    ))
    text = F.when(F.col("n_hit") > 0, F.array_join(left, "")).otherwise(F.col("text")).alias("text")
    return found.select([text if name == "text" else F.col(name) for name in docs.columns])
