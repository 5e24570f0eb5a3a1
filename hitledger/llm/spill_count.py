"""Counts of keys over all rows, and what the counts of each row's keys come to, by runs outside memory.

Tasks sort (key, row) records in memory, a bounded number at a time, cut them
by the radix of the key's major side, and give each cut away as a run: zstd
frames of its distinct keys with their counts, and of the rows behind them. Runs
of a radix are merged by a heap, block by block, in key order. That order has all
keys of a major side together, so its highest count is known as the merge
passes; counts and marks of the highest then stream past the runs, which hand
every row its share. Runs of a radix are dealt over slices by how many entries
they hold, and merged slice by slice in rounds, so that one hot side has many
tasks; only counts of distinct keys ever meet in one.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.llm.stages import Stages
from hitledger.llm.textbytes import mix, tidy

#: Cuts of the major sides.
RADICES = 32
#: Records that a task holds before it gives runs away.
RUN_RECORDS = 2_000_000
#: Entries of a frame: what a merge holds of a run.
BLOCK = 1 << 15
#: Distinct keys (of all runs), or records, of a radix that one task goes through.
SLICE_KEYS, SLICE_RECORDS = 8_000_000, 32_000_000
#: Runs that are open in one merge; more are merged in turns.
OPEN_RUNS = 64
#: Keys of one row of the table of counts.
TABLE_KEYS = 1 << 18

Blocks = Iterator[tuple[np.ndarray, ...]]


def radix_order(sides: int) -> tuple[np.ndarray, np.ndarray]:
    """The place of every major side in the order by (radix, side), and where each radix begins in it (and the last ends)."""
    radix = (mix(np.arange(sides, dtype=np.uint64)) % np.uint64(RADICES)).astype(np.int64)
    order = np.argsort(radix, kind="stable")
    place = np.empty(sides, np.int64)
    place[order] = np.arange(sides)
    return place, np.searchsorted(radix[order], np.arange(RADICES + 1))


def packed(*columns: np.ndarray) -> bytes:
    """Columns in blocks, a zstd frame for each column of a block, its length before it; int64 columns are sorted keys."""
    out, pack = [], zstandard.ZstdCompressor(level=1)
    for at in range(0, len(columns[0]), BLOCK):
        for column in columns:
            own = column[at : at + BLOCK]
            own = np.diff(own, prepend=0) if own.dtype == np.int64 else own  # small steps
            frame = pack.compress(own.astype(own.dtype.newbyteorder("<")).tobytes())
            out += [len(frame).to_bytes(4, "little"), frame]
    return b"".join(out)


def unpacked(blob: bytes, *kinds: str) -> Blocks:
    """The blocks again, one at a time."""
    unpack, at = zstandard.ZstdDecompressor(), 0
    while at < len(blob):
        block = []
        for kind in kinds:
            n = int.from_bytes(blob[at : at + 4], "little")
            own = np.frombuffer(unpack.decompress(blob[at + 4 : at + 4 + n]), kind)
            block.append(np.cumsum(own) if kind == "<i8" else own)
            at += 4 + n
        yield tuple(block)


def _counts_of(blob: bytes) -> Blocks:
    return (block[:2] for block in unpacked(blob, "<i8", "<u8", "<u4"))


def merged(runs: list[Blocks]) -> Blocks:
    """Distinct keys of sorted runs in order, with their counts added: a merge by a heap of the blocks' last keys.

    Up to the least of these last keys every run is in memory, so all that is not beyond it can go out.
    """
    held: dict[int, tuple[np.ndarray, ...]] = {}
    heap: list[tuple[int, int]] = []

    def refill(i: int) -> None:
        block = next(runs[i], None)
        if block is None:
            held.pop(i, None)
        else:
            held[i] = block
            heapq.heappush(heap, (int(block[0][-1]), i))

    for i in range(len(runs)):
        refill(i)
    while heap:
        last, i = heapq.heappop(heap)
        keys, counts = [], []
        for k, (own_keys, own_counts) in held.items():
            end = int(np.searchsorted(own_keys, last, "right"))
            if end:
                keys.append(own_keys[:end])
                counts.append(own_counts[:end])
                held[k] = own_keys[end:], own_counts[end:]
        refill(i)
        if keys:
            found = np.concatenate(keys)
            order = np.argsort(found, kind="stable")
            found = found[order]
            new = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
            yield found[new], np.add.reduceat(np.concatenate(counts)[order], new)


def _in_blocks(blocks: Blocks, size: int) -> Blocks:
    """The same entries in blocks of at least ``size`` (the last: what is left)."""
    kept: list[tuple[np.ndarray, ...]] = []
    for block in blocks:
        kept.append(block)
        if sum(len(b[0]) for b in kept) >= size:
            yield tuple(map(np.concatenate, zip(*kept)))
            kept = []
    if kept:
        yield tuple(map(np.concatenate, zip(*kept)))


def merged_all(blobs: Iterable[bytes]) -> Blocks:
    """A merge of any number of runs, at most OPEN_RUNS at once; runs that were merged on the way are packed again."""
    turns: list[list[bytes]] = [[]]
    for blob in blobs:
        turns[0].append(blob)
        level = 0
        while len(turns[level]) == OPEN_RUNS:
            found = _in_blocks(merged([_counts_of(b) for b in turns[level]]), BLOCK)
            whole = b"".join(packed(k, c, np.zeros(len(k), np.uint32)) for k, c in found)
            turns[level] = []
            level += 1
            if level == len(turns):
                turns.append([])
            turns[level].append(whole)
    return merged([_counts_of(b) for turn in turns for b in turn])


class Recorder:
    """Takes the (key, row) records of one task and gives runs away.

    A key is the place of its major side in :func:`radix_order`, then its other side in ``low_bits`` bits.
    """

    FIELDS = "radix int, run long, n_keys long, n_records long, first_row long, keys binary, rows binary"

    def __init__(self, sides: int, low_bits: int, task: int):
        self.place, starts = radix_order(sides)
        self.starts = starts.astype(np.int64) << low_bits
        self.low_bits, self.task, self.runs, self.held = low_bits, task, 0, 0
        self.keys: list[np.ndarray] = []
        self.rows: list[np.ndarray] = []

    def add(self, majors: np.ndarray, others: np.ndarray, rows: np.ndarray) -> Iterator[dict[str, list]]:
        """Records, any number of times each; ``rows`` are numbers within the task."""
        keys = self.place[majors] << self.low_bits | others
        for at in range(0, len(keys), RUN_RECORDS):
            self.keys.append(keys[at : at + RUN_RECORDS])
            self.rows.append(rows[at : at + RUN_RECORDS])
            self.held += len(self.keys[-1])
            if self.held >= RUN_RECORDS:
                yield self.flush()

    def flush(self) -> dict[str, list]:
        """One run for each radix among the records held."""
        out: dict[str, list] = {field.split()[0]: [] for field in self.FIELDS.split(", ")}
        if not self.held:
            return out
        keys, rows = np.concatenate(self.keys), np.concatenate(self.rows)
        self.keys, self.rows, self.held = [], [], 0
        least = int(rows.min())
        rows = rows - least
        bits = int(rows.max()).bit_length()
        if int(keys.max()).bit_length() + bits <= 63:
            both = keys << bits | rows
            both.sort()
            keys, rows = both >> bits, both & ((1 << bits) - 1)
        else:
            order = np.lexsort((rows, keys))
            keys, rows = keys[order], rows[order]
        new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])]))
        n = np.diff(np.append(new, len(keys))).astype(np.uint64)
        keys, rows = keys[new], rows[new].astype(np.uint32)
        edges = np.searchsorted(keys, self.starts)
        for radix, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            if a == b:
                continue
            own = np.flatnonzero(np.concatenate([[True], keys[a + 1 : b] != keys[a : b - 1]]))
            spans = np.diff(np.append(own, b - a)).astype(np.uint32)
            row = [
                radix, (self.task << 24) + self.runs, len(own), b - a, least,
                packed(keys[a:b][own], np.add.reduceat(n[a:b], own), spans), packed(rows[a:b], n[a:b]),
            ]
            for column, value in zip(out.values(), row):
                column.append(value)
        self.runs += 1
        return out


def _slices(parts: DataFrame, amount: str, limit: int) -> list[int]:
    """Slices of each radix: one row a radix comes to the driver."""
    sizes = {r.radix: r.n for r in parts.groupBy("radix").agg(F.sum(amount).alias("n")).collect()}
    return [-(-max(1, sizes.get(radix, 0)) // limit) for radix in range(RADICES)]


def _slices_of(slices: list[int]) -> Column:
    return F.element_at(F.array(*map(F.lit, slices)), F.col("radix") + 1)


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], dict]]:
    """Rows as ((radix, slice), row)."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
            yield (row["radix"], row["slice"]), row


def _grouped(rows: Iterator[tuple[tuple[int, int], dict]]) -> Iterator[tuple[tuple[int, int], Iterator[dict]]]:
    """Groups of neighbouring rows, each to be read before the next is asked for."""
    for group, own in itertools.groupby(rows, lambda x: x[0]):
        yield group, (row for _, row in own)


def _merge_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (radix, part), rows in _grouped(_groups(batches)):
        for k, (keys, counts) in enumerate(_in_blocks(merged_all(r["keys"] for r in rows), SLICE_KEYS // 8)):
            yield pa.record_batch(
                [pa.array([radix], pa.int32()), pa.array([(part << 24) + k], pa.int64()), pa.array([len(keys)], pa.int64()),
                 pa.array([packed(keys, counts, np.zeros(len(keys), np.uint32))], pa.binary())],
                names=["radix", "run", "n_keys", "keys"],
            )


def _with_best(blocks: Blocks, low_bits: int) -> Blocks:
    """Blocks of whole major sides, with a mark at the keys whose count is their side's highest (ties too)."""
    rest: tuple[np.ndarray, ...] | None = None
    for block in blocks:
        if rest is not None:
            block = tuple(map(np.concatenate, zip(rest, block)))
        side = block[0] >> low_bits
        end = int(np.searchsorted(side, side[-1]))
        rest = tuple(column[end:] for column in block)  # its side may go on
        if end:
            yield _marked(block[0][:end], block[1][:end], side[:end])
    if rest is not None:
        yield _marked(*rest, rest[0] >> low_bits)


def _marked(keys: np.ndarray, counts: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, ...]:
    first = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
    highest = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(side))))
    return keys, counts, (counts == highest).astype(np.uint8)


TABLE = "radix int, chunk long, counts binary"


def count_runs(stages: Stages, runs: DataFrame, low_bits: int) -> DataFrame:
    """The table of counts of all runs: every distinct key with its count and the mark of its side's highest."""
    heads = runs.select("radix", "run", "n_keys", "keys")
    while max(slices := _slices(heads, "n_keys", SLICE_KEYS)) > 1:
        dealt = heads.withColumn("slice", F.pmod(F.xxhash64("run"), _slices_of(slices)).cast("long"))
        dealt = dealt.select("radix", "slice", "keys").repartition(2 * sum(slices), "radix", "slice").sortWithinPartitions("radix", "slice")
        smaller = stages.write(dealt.mapInArrow(tidy(stages.spark, _merge_slices), "radix int, run long, n_keys long, keys binary"), "merged")
        stuck = sum(_slices(smaller, "n_keys", 1)) > 0.9 * sum(_slices(heads, "n_keys", 1))
        heads = smaller
        if stuck:  # hardly a key in two slices: one merge does the rest
            break

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (radix, _), rows in _grouped(_groups(batches)):
            blocks = _in_blocks(_with_best(merged_all(r["keys"] for r in rows), low_bits), TABLE_KEYS)
            for chunk, columns in enumerate(blocks):
                yield pa.record_batch(
                    [pa.array([radix], pa.int32()), pa.array([chunk], pa.int64()), pa.array([packed(*columns)], pa.binary())],
                    names=["radix", "chunk", "counts"],
                )

    whole = heads.select("radix", F.lit(0).alias("slice"), "keys").repartition(2 * RADICES, "radix").sortWithinPartitions("radix")
    return stages.write(whole.mapInArrow(tidy(stages.spark, table), TABLE), "counts")


def counted_keys(table: DataFrame, low_bits: int) -> DataFrame:
    """The table as rows: place long (of the major side in its order), other long, n long, best boolean."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                for keys, counts, best in unpacked(blob, "<i8", "<u8", "|u1"):
                    yield pa.record_batch(
                        [pa.array(keys >> low_bits), pa.array(keys & ((1 << low_bits) - 1)), pa.array(counts.astype(np.int64)), pa.array(best == 1)],
                        names=["place", "other", "n", "best"],
                    )

    return table.select("counts").mapInArrow(tidy(table.sparkSession, rows), "place long, other long, n long, best boolean")


def shares(stages: Stages, runs: DataFrame, table: DataFrame) -> DataFrame:
    """task long, row long, n_best long (records of a key that is its side's highest), count_sum long (counts over records)."""
    slices = _slices(runs, "n_records", SLICE_RECORDS)
    known = table.select(
        "radix", F.explode(F.sequence(F.lit(0), _slices_of(slices) - 1)).alias("slice"), F.lit(0).alias("kind"), F.col("chunk").alias("no"),
        F.col("counts").alias("keys"), F.lit(None).cast("binary").alias("rows"), F.lit(0).cast("long").alias("first_row"),
    )
    own = runs.select(
        "radix", F.pmod(F.xxhash64("run"), _slices_of(slices)).cast("int").alias("slice"), F.lit(1).alias("kind"), F.col("run").alias("no"),
        "keys", "rows", "first_row",
    )
    dealt = known.union(own).repartition(2 * sum(slices), "radix", "slice").sortWithinPartitions("radix", "slice", "kind", "no")

    def hand_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(_groups(batches)):
            chunks, columns = [], None
            for row in rows:
                if row["kind"] == 0:
                    chunks += unpacked(row["keys"], "<i8", "<u8", "|u1")
                    continue
                if columns is None:
                    columns = tuple(map(np.concatenate, zip(*chunks)))
                    chunks = []
                keys, _, spans = map(np.concatenate, zip(*unpacked(row["keys"], "<i8", "<u8", "<u4")))
                numbers, n = map(np.concatenate, zip(*unpacked(row["rows"], "<u4", "<u8")))
                at = np.searchsorted(columns[0], keys)
                n = n.astype(np.int64)
                sums, best = (np.zeros(int(numbers.max()) + 1, np.int64) for _ in range(2))
                np.add.at(sums, numbers, n * np.repeat(columns[1][at].astype(np.int64), spans))
                np.add.at(best, numbers, n * np.repeat(columns[2][at].astype(np.int64), spans))
                found = np.flatnonzero(sums)
                yield pa.record_batch(
                    [pa.array(np.full(len(found), row["no"] >> 24)), pa.array(found + row["first_row"]), pa.array(best[found]), pa.array(sums[found])],
                    names=["task", "row", "n_best", "count_sum"],
                )

    found = dealt.mapInArrow(tidy(stages.spark, hand_out), "task long, row long, n_best long, count_sum long")
    return found.groupBy("task", "row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
