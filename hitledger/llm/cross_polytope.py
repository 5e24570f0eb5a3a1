"""Approximate nearest neighbours by cross-polytope hashing.

Unit vectors are turned by pseudo-random rotations (three rounds of random signs
and a fast Hadamard transform); the signed axis that is nearest afterwards is
the bucket. A query asks several buckets of every table, nearest axes first.
What it meets there is ranked by exact distance between the original vectors.

Buckets are dealt in blocks, so that a hot one is many tasks' work; only the
best of each block leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitledger.llm.stages import Stages
from hitledger.llm.textbytes import tidy

#: Vectors of a bucket that a task compares at once with a block of queries.
BLOCK = 2048


@dataclass(frozen=True)
class Index:
    """``tables`` rotations; a query asks ``probes`` of the 2 * d buckets of each (d: the dimension, rounded up to a power of 2)."""

    tables: int = 10
    probes: int = 28
    seed: int = 3


def _hadamard(x: np.ndarray) -> np.ndarray:
    n = x.shape[1]
    step = 1
    while step < n:
        x = x.reshape(len(x), n // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(len(x), n)
        step *= 2
    return x / np.sqrt(n)


def rotations(unit: np.ndarray, index: Index) -> np.ndarray:
    """(tables, n, d) pseudo-random rotations of the rows of ``unit``."""
    n, width = unit.shape
    d = 1 << max(width - 1, 1).bit_length()
    padded = np.zeros((n, d))
    padded[:, :width] = unit
    signs = np.random.default_rng([index.seed, d]).choice([-1.0, 1.0], (index.tables, 3, d))
    out = []
    for table in signs:
        x = padded
        for s in table:
            x = _hadamard(x * s)
        out.append(x)
    return np.array(out)


def axes(rotated: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` nearest signed axes of each row, nearest first; axis i and its opposite are i and d + i."""
    both = np.concatenate([rotated, -rotated], 1)
    return np.argsort(-both, axis=1, kind="stable")[:, :probes]


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths of the lists, and for the usable rows their places and values, by length."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become nan
    return lengths, np.concatenate([[0], np.cumsum(lengths)]), values


def hashed(vectors: DataFrame, index: Index, probes: int) -> DataFrame:
    """(vec_id, dim, table, bucket, values): every usable vector in its nearest ``probes`` buckets of each table."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                ids = batch.column(0)
                lengths, offsets, values = _matrix(batch.column(1))
                for dim in np.unique(lengths[lengths > 0]):
                    own = np.flatnonzero(lengths == dim)
                    own = own[ids.is_valid().to_numpy(zero_copy_only=False)[own]]
                    x = values[offsets[own][:, None] + np.arange(dim)]
                    norm = np.sqrt((x * x).sum(1))
                    good = np.isfinite(x).all(1) & (norm > 0) & np.isfinite(norm)
                    own, x, norm = own[good], x[good], norm[good]
                    if not len(own):
                        continue
                    turned = rotations(x / norm[:, None], index)
                    found = np.stack([axes(t, probes) for t in turned], 1)  # (n, tables, probes)
                    n, per = len(own), found.shape[1] * found.shape[2]
                    flat = np.repeat(x, per, 0).ravel()
                    yield pa.record_batch(
                        [
                            ids.take(pa.array(np.repeat(own, per))), pa.array(np.full(n * per, dim, np.int32)),
                            pa.array(np.tile(np.repeat(np.arange(found.shape[1], dtype=np.int32), found.shape[2]), n)),
                            pa.array(found.ravel().astype(np.int32)),
                            pa.ListArray.from_arrays(np.arange(0, (n * per + 1) * int(dim), int(dim), dtype=np.int32), flat),
                        ],
                        names=["vec_id", "dim", "table", "bucket", "values"],
                    )

    return vectors.mapInArrow(tidy(vectors.sparkSession, rows), "vec_id long, dim int, table int, bucket int, values array<double>")


def _best_in_blocks(dealt: DataFrame, top: int) -> DataFrame:
    """(query_id, vec_id, score): of each block and query the ``top`` nearest, equal (vec_id, score) as one.

    ``dealt``: (dim, table, bucket, block, side, vec_id, values); side 0 are the vectors, side 1 the queries.
    """
    key = ["dim", "table", "bucket", "block"]
    dealt = dealt.repartition(*key).sortWithinPartitions(*key, "side", "vec_id")

    def nearest(sides: np.ndarray, ids: np.ndarray, x: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        split = int(np.searchsorted(sides, 1))
        base, base_ids, out = x[:split], ids[:split], []
        for q, own in zip(ids[split:], x[split:]):
            gap = base - own
            score = np.sqrt((gap * gap).sum(1))
            others = np.flatnonzero(base_ids != q)
            others = others[np.lexsort((base_ids[others], score[others]))]
            new = np.ones(len(others), bool)
            new[1:] = (base_ids[others[1:]] != base_ids[others[:-1]]) | (score[others[1:]] != score[others[:-1]])
            best = others[new][:top]
            out.append((np.full(len(best), q), base_ids[best], score[best]))
        return out

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            sides, ids, x = (np.concatenate([p[i] for p in pending]) for i in (1, 2, 3))
            pending.clear()
            found = nearest(sides, ids, x) or [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
            return pa.record_batch([np.concatenate(c) for c in zip(*found)], names=["query_id", "vec_id", "score"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy() for i in range(4)], 1)
            sides, ids = batch.column(4).to_numpy(), batch.column(5).to_numpy()
            offsets = np.concatenate([[0], np.cumsum(keys[:, 0])])
            values = batch.column(6).flatten().to_numpy()
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if pending and (pending[-1][0] != keys[a]).any():
                    yield flush()
                x = values[offsets[a] : offsets[b]].reshape(b - a, keys[a][0])
                pending.append((keys[a], sides[a:b], ids[a:b], x))
        if pending:
            yield flush()

    return dealt.mapInArrow(tidy(dealt.sparkSession, rows), "query_id long, vec_id long, score double")


def _meet(base: DataFrame, queries: DataFrame, top: int) -> DataFrame:
    """Deals vectors and queries of equal (dim, table, bucket) in blocks, and searches these."""
    key = ["dim", "table", "bucket"]
    sizes = base.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    # One row for each bucket: at most 2 * d * tables of each dimension.
    sizes = F.broadcast(sizes)
    block = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    columns = [*key, "block", "side", "vec_id", "values"]
    vectors = base.join(sizes, key).withColumns({"block": block, "side": F.lit(0)}).select(columns)
    asked = queries.join(sizes, key).withColumns({"block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "side": F.lit(1)})
    return _best_in_blocks(vectors.union(asked.select(columns)), top)


def _first(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def neighbours(vectors: DataFrame, queries: DataFrame, top: int = 10, index: Index = Index()) -> DataFrame:
    """The ``top`` nearest vectors found for each query: query_id, rank (from 1), vec_id, score.

    Both tables have vec_id long and embedding array<float or double>; other
    columns are ignored. A query does not find the row of its own id. Score is
    the Euclidean distance of the original vectors in double precision; ties go to
    the smaller vec_id. Vectors that are null, empty or zero or hold null or
    non-finite components, and rows without vec_id, take no part, as query or as
    candidate; vectors meet those of their own length only. Rows that repeat
    id and vector count once. A query that meets fewer than ``top`` vectors in its
    buckets is compared with all, so it gets fewer only if there are no more.
    """
    stages = Stages(vectors.sparkSession, "neighbours")
    # Repeated rows go before any cut, so that they crowd out no others.
    of = lambda rows, probes: hashed(rows.select("vec_id", "embedding").distinct(), index, probes)
    base = stages.write(of(vectors, 1), "base")
    asked = stages.write(of(queries, index.probes), "asked")
    found = stages.write(_first(_meet(base, asked, top), top), "found")
    stages.drop(asked)
    whole = stages.write(of(queries, 1).where("table = 0"), "queries")
    got = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("got"))
    met = whole.join(got, F.col("vec_id") == F.col("query_id"), "left")
    short = stages.write(met.where(F.coalesce("got", F.lit(0)) < top).select(whole.columns), "short")
    if not short.isEmpty():
        one = base.where("table = 0").withColumn("bucket", F.lit(0))
        rest = _first(_meet(one, short.withColumn("bucket", F.lit(0)), top), top)
        found = found.join(short.select(F.col("vec_id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(rest)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
