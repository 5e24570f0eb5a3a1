"""Token ids of two tokenizers side by side: which tokens share bytes, and how often ids do so in all texts.

Both tokenizers cut a text (with a blank before it) into tokens that cover its
bytes. Where a token of each ends at the same byte, a group ends; tokens of a
group that overlap are linked. How often two ids are linked in all texts, and
whether an id has no partner with more links, comes from
:mod:`hitledger.llm.spill_count`.

Neither tokenizer joins a blank to what stands before it, so texts are cut
before blanks, and a worker asks the tokenizers once for every distinct chunk.
"""

from __future__ import annotations

import hashlib
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.llm.spill_count import Recorder, count_runs, counted_keys, radix_order, shares
from hitledger.llm.stages import Stages
from hitledger.llm.textbytes import pieces, tidy

#: Distinct chunks that a worker keeps, and bytes of text in a step.
CACHED_CHUNKS, TEXT_BYTES = 300_000, 1 << 20


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible ones for themselves, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class ByteSide:
    """A byte-level tokenizer of the ``tokenizers`` library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.n_ids = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.bytes = [b""] * self.n_ids
        table = byte_level()
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.bytes[i] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()
        self.splits = True  # its pattern never lets a token go on from a visible character to a blank

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class PieceSide:
    """A sentencepiece model that sets a blank before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.n_ids = len(self.model)
        names = [self.model.id_to_piece(i) for i in range(self.n_ids)]
        self.bytes = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace("▁", " ").encode() for i, name in enumerate(names)
        ]
        # Chunks can stand alone if no piece goes on from another character to a blank.
        self.splits = not any("▁" in name.lstrip("▁") for name in names)

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text[1:], num_threads=1)


def chunk_starts(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where chunks begin: at the rows' first bytes and at blanks after a character that is surely no white space."""
    if not len(data):
        return np.zeros(0, np.int64)
    last, lead2, lead3 = (np.concatenate([np.full(k, 32, np.uint8), data[:-k]]) if len(data) > k else np.full(len(data), 32, np.uint8) for k in (1, 2, 3))
    # Odd white space begins with the bytes C2, E1, E2, E3.
    sure = (last > 0x20) & (last != 0x7F) & ~((last >= 0x80) & ((lead2 == 0xC2) | ((lead3 >= 0xE1) & (lead3 <= 0xE3))))
    start = (data == 0x20) & sure
    start[rows[1:] - 1] = start[-1] = False  # a blank that ends its row is no text of its own
    start[rows] = True
    return np.flatnonzero(start)


class Aligner:
    """Both sides of chunks, each distinct chunk worked out once (until there are too many)."""

    def __init__(self, a: ByteSide, b: PieceSide):
        self.a, self.b = a, b
        self.sizes = [np.array([len(x) for x in side.bytes], np.int64) for side in (a, b)]
        self.names = [[str(i).encode() for i in range(side.n_ids)] for side in (a, b)]
        self._clear()

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.groups: list[bytes] = []
        self.facts = np.zeros((1 << 12, 5), np.int64)  # good, n_a, n_b, n_groups, first link
        self.links = np.zeros((1 << 14, 2), np.int32)
        self.n_links = 0

    def _learn_alone(self, chunk: bytes) -> bool:
        text = chunk.decode("utf-8")
        ids = [np.array(side.encode(text), np.int64) for side in (self.a, self.b)]
        good = all(b"".join(side.bytes[i] for i in own.tolist()) == chunk for side, own in zip((self.a, self.b), ids))
        self._keep([chunk], np.array([0, len(chunk)]), ids if good else None)
        return good

    def _keep(self, chunks: list[bytes], bounds: np.ndarray, ids: list[np.ndarray] | None) -> None:
        """Facts of chunks that lie one after the other at ``bounds``, from their tokens; without tokens they are no good."""
        n, m = len(self.known), len(chunks)
        while len(self.facts) < n + m + 1:
            self.facts = np.concatenate([self.facts, np.zeros_like(self.facts)])
        self.known.update(zip(chunks, range(n, n + m)))
        if ids is None:
            self.groups += [b""] * m
            self.facts[n : n + m] = 0, 0, 0, 0, self.n_links
            self.facts[n + m, 4] = self.n_links
            return
        ends = [np.cumsum(size[own]) for size, own in zip(self.sizes, ids)]
        starts = [end - size[own] for end, size, own in zip(ends, self.sizes, ids)]
        # Tokens of B that overlap each token of A.
        first = np.searchsorted(ends[1], starts[0], "right")
        many = np.searchsorted(starts[1], ends[0], "left") - first
        total = np.cumsum(many)
        other = np.arange(total[-1]) + np.repeat(first - total + many, many)
        links = np.stack([np.repeat(ids[0], many), ids[1][other]], 1)
        while len(self.links) < self.n_links + len(links):
            self.links = np.concatenate([self.links, np.zeros_like(self.links)])
        self.links[self.n_links : self.n_links + len(links)] = links
        cuts = ends[0][np.isin(ends[0], ends[1], assume_unique=True)]
        at = [np.searchsorted(end, cuts, "left") + 1 for end in ends]
        shown = [[names[i] for i in own.tolist()] for names, own in zip(self.names, ids)]
        group_texts, i0, j0 = [], 0, 0
        for i, j in zip(at[0].tolist(), at[1].tolist()):
            group_texts.append(b",".join(shown[0][i0:i]) + b"|" + b",".join(shown[1][j0:j]))
            i0, j0 = i, j
        of_chunk = np.searchsorted(cuts, bounds[1:], "right")
        group_first = np.concatenate([[0], of_chunk])
        self.groups += [b";".join(group_texts[x:y]) for x, y in zip(group_first[:-1].tolist(), group_first[1:].tolist())]
        tokens = [np.diff(np.searchsorted(end, bounds, "right")) for end in ends]
        link_end = np.concatenate([[0], total])[np.searchsorted(ends[0], bounds, "right")] + self.n_links
        self.facts[n : n + m] = np.stack([np.ones(m, np.int64), *tokens, np.diff(group_first), link_end[:-1]], 1)
        self.n_links += len(links)
        self.facts[n + m, 4] = self.n_links

    def _learn(self, new: list[bytes]) -> None:
        closed = []
        for chunk in new:
            # Chunks that can follow each other in one text; those with odd characters are asked for alone.
            closes = 0x20 < chunk[-1] < 0x7F or chunk[-2:-1] == b"\xc3"
            if self.a.splits and self.b.splits and len(chunk) <= 200 and closes and b"\xe2\x96\x81" not in chunk:
                closed.append(chunk)
            else:
                self._learn_alone(chunk)
        for at in range(0, len(closed), 1000):
            group = closed[at : at + 1000]
            whole = b"".join(group)
            text, bounds = whole.decode("utf-8"), np.concatenate([[0], np.cumsum([len(c) for c in group])])
            ids = [np.array(side.encode(text), np.int64) for side in (self.a, self.b)]
            fits = all(
                b"".join(side.bytes[i] for i in own.tolist()) == whole and np.isin(bounds[1:], np.cumsum(size[own])).all()
                for side, size, own in zip((self.a, self.b), self.sizes, ids)
            )
            if fits:
                self._keep(group, bounds, ids)
            else:
                for chunk in group:
                    self._learn_alone(chunk)

    def chunks(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all chunks of all rows, and the rows' bounds in them; an empty row has none."""
        if len(self.known) > CACHED_CHUNKS:
            self._clear()
        filled = np.flatnonzero(np.diff(offsets))
        if not len(filled):
            return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        blank = np.insert(data, offsets[:-1][filled], 0x20)
        rows = offsets[:-1][filled] + np.arange(len(filled))
        if self.a.splits and self.b.splits:
            starts = chunk_starts(blank, rows)
        else:
            starts = rows
        bounds = np.append(starts, len(blank)).astype(np.int64)
        array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(blank)]).dictionary_encode()
        distinct = array.dictionary.to_pylist()
        new = [c for c in distinct if c not in self.known]
        if new:
            self._learn(new)
        place = np.array([self.known[c] for c in distinct], np.int64)
        of_row = np.zeros(len(offsets), np.int64)
        first = np.searchsorted(starts, rows)
        of_row[filled + 1] = np.append(first[1:], len(starts)) - first
        return place[array.indices.to_numpy()], np.cumsum(of_row)


def _worker_aligner(a_path: str, b_path: str) -> Aligner:
    """The aligner that this Python worker keeps for all its tasks."""
    name = "_hitledger_worker_aligner"
    kept = sys.modules.setdefault(name, types.ModuleType(name))
    if getattr(kept, "paths", None) != (a_path, b_path):
        kept.paths, kept.aligner = (a_path, b_path), Aligner(ByteSide(a_path), PieceSide(b_path))
    return kept.aligner


COUNTED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def _bits(n: int) -> int:
    return max(1, int(n - 1).bit_length())


class Alignment:
    """Links of all texts of ``docs`` (doc_id, text), counted.

    Every row is a text of its own, repeated rows too. A text that is null or empty, or whose tokens of either side do
    not join to its bytes, has no tokens: zeros, and an empty ``groups_sha256``. Other columns of ``docs`` are not looked
    at and not returned. An empty table gives empty results.
    """

    def __init__(self, docs: DataFrame, a_path: str, b_path: str):
        self.stages = Stages(docs.sparkSession, "align")
        a, b = ByteSide(a_path), PieceSide(b_path)
        self.sides, self.low_bits = b.n_ids, _bits(a.n_ids)
        sides, low_bits = self.sides, self.low_bits

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            aligner, task = _worker_aligner(a_path, b_path), TaskContext.get().partitionId()
            recorder, done = Recorder(sides, low_bits, task), 0
            for batch in batches:
                for part, data, offsets in pieces(batch, "text", TEXT_BYTES):
                    found, links, owner = _aligned(aligner, data, offsets)
                    yield _batch(schema, doc_id=part.column(0), row=np.arange(done, done + part.num_rows), task=np.full(part.num_rows, task), **found)
                    for runs in recorder.add(links[:, 1].astype(np.int64), links[:, 0].astype(np.int64), owner + done):
                        yield _batch(schema, task=np.full(len(runs["radix"]), task), **runs)
                    done += part.num_rows
            runs = recorder.flush()
            yield _batch(schema, task=np.full(len(runs["radix"]), task), **runs)

        rows = docs.select("doc_id", "text")
        kind = rows.schema["doc_id"].dataType.simpleString()
        names = f"doc_id {kind}, task long, row long, {COUNTED}, {Recorder.FIELDS}"
        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import StructType

        schema = to_arrow_schema(StructType.fromDDL(names))
        stored = self.stages.write(rows.mapInArrow(tidy(docs.sparkSession, work), names), "runs")
        self._texts = stored.where("row is not null").select("doc_id", "task", "row", *[c.split()[0] for c in COUNTED.split(", ")])
        self._runs = stored.where("radix is not null")
        self._table = count_runs(self.stages, self._runs, low_bits)

    def texts(self) -> DataFrame:
        """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

        ``n_best`` are the links whose ids are linked as often as any with that id of B, ``count_sum`` adds up how
        often the ids of each link are linked in all texts.
        """
        given = shares(self.stages, self._runs, self._table)
        found = self._texts.join(given, ["task", "row"], "left")
        sums = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
        return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *sums, "groups_sha256")

    def pairs(self) -> DataFrame:
        """a, b, n and best of every pair of ids that is linked anywhere."""
        place, _ = radix_order(self.sides)
        order = np.argsort(place).tolist()
        sides = self.stages.spark.createDataFrame([(p, i) for p, i in enumerate(order)], "place long, b long")
        return counted_keys(self._table, self.low_bits).join(sides, "place").select(F.col("other").alias("a"), "b", "n", "best")


def _aligned(aligner: Aligner, data: np.ndarray, offsets: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray]:
    """Counts and digests of the rows, all links, and the row of each link."""
    place, first = aligner.chunks(data, offsets)
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(first))
    facts = aligner.facts[place]
    bad = np.bincount(row, facts[:, 0] == 0, n) > 0
    empty = bad | (np.diff(first) == 0)
    facts[bad[row], 1:4] = 0
    many = np.where(bad[row], 0, aligner.facts[place + 1, 4] - aligner.facts[place, 4])
    sums = [np.bincount(row, column, n).astype(np.int64) for column in (*facts[:, 1:4].T, many)]
    total = np.cumsum(many)
    at = np.arange(total[-1] if len(total) else 0) + np.repeat(aligner.facts[place, 4] - total + many, many)
    groups, digests, listed = aligner.groups, [], place.tolist()
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        digests.append("" if empty[i] else hashlib.sha256(b";".join([groups[k] for k in listed[a:b]])).hexdigest())
    found = {"n_a": sums[0], "n_b": sums[1], "n_groups": sums[2], "n_links": sums[3], "groups_sha256": digests}
    return found, aligner.links[at], np.repeat(row, many)


def _batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    n = len(columns["task"])
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema]
    return pa.record_batch(arrays, schema=schema)
