"""Token ids as Parquet list columns, in document order.

``ids`` is dictionary-encoded, the numbers beside it are delta-encoded (format
version 2); row groups are small, and page indexes cover pages of few rows, so
that a reader takes only the rows, pages and columns it asks for.
"""

from __future__ import annotations

import os
import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitledger.llm.textbytes import byte_table, pieces, tidy

ROW_GROUP_BYTES = 16 << 20
PAGE_ROWS = 256
#: Bytes of text that are cut into pieces at once: each distinct piece among them is looked up once.
TEXT_BYTES = 2 << 20
#: Distinct pieces whose ids a Python worker keeps.
CACHED_PIECES = 500_000

FILE_OPTIONS = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
    "parquet.page.row.count.limit": str(PAGE_ROWS),
    "compression": "zstd",
}

# Byte classes: a text may be cut between two bytes of different classes, and after each digit.
_BLANK, _LETTER, _DIGIT, _MARK, _ODD = range(5)

# ASCII without the two odd marks, and Latin letters of two bytes.
PLAIN = re.compile(rb"(?:[\x00-&(-;=-\x7f]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def _classes() -> np.ndarray:
    table = np.full(256, _MARK, np.uint8)
    table[[32, *range(9, 14)]] = _BLANK
    table[[*range(65, 91), *range(97, 123)]] = _LETTER
    table[48:58] = _DIGIT
    table[[ord("'"), ord("<")]] = _ODD  # contractions, special tokens
    table[128:] = _ODD
    return table


class PieceEncoder:
    """Encodes texts piece by piece, with the tokenizer asked once for each distinct piece.

    For tokenizers that fold case and split at blanks, between letters, digits
    and other characters, and around each digit, and whose last token of a split
    ends with a mark of its own. Words with characters whose class or
    normal form depends on their neighbours are one piece, encoded whole.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.closing[i] = token.endswith("</w>")
        self.table = _classes()
        self.lower = byte_table(b"")
        self._clear()

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {b"": 0}
        self.ids = np.zeros(1 << 16, np.int32)
        self.bounds = np.zeros(1 << 16, np.int32)  # ids of piece k: bounds[k] to bounds[k + 1]

    def _append(self, ids: np.ndarray, counts: np.ndarray) -> None:
        n, used = len(self.known), self.bounds[len(self.known)]
        while len(self.bounds) < n + len(counts) + 2:
            self.bounds = np.concatenate([self.bounds, np.zeros_like(self.bounds)])
        while len(self.ids) < used + len(ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[used : used + len(ids)] = ids
        self.bounds[n + 1 : n + 1 + len(counts)] = used + np.cumsum(counts)

    def _learn(self, new: list[bytes]) -> None:
        plain, odd = [], []
        for piece in new:
            (plain if len(piece) <= 200 and (piece.isalpha() or PLAIN.fullmatch(piece)) else odd).append(piece)
        for at in range(0, len(plain), 2000):
            group = plain[at : at + 2000]
            text = b" ".join(group).decode("utf-8")
            # The fast form gives the same ids and leaves out where in the text they are.
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            ends = np.flatnonzero(self.closing[ids]) + 1
            if len(ends) == len(group) and ends[-1] == len(ids):
                self._append(ids, np.diff(ends, prepend=0))
                self.known.update(zip(group, range(len(self.known), len(self.known) + len(group))))
            else:
                odd += group
        for piece in odd:
            ids = self.tokenizer.encode(piece.decode("utf-8"), add_special_tokens=False).ids
            self._append(np.array(ids, np.int32), np.array([len(ids)]))
            self.known[piece] = len(self.known)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, one after the other, and the n + 1 bounds of the rows in them."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        if len(self.known) > CACHED_PIECES:
            self._clear()
        kind = self.table[data]
        # Latin letters of two bytes are letters like any other; × and ÷ are not.
        lead = np.flatnonzero(data[:-1] == 0xC3)
        lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
        kind[lead] = kind[lead + 1] = _LETTER
        cut = np.ones(len(data), bool)
        np.not_equal(kind[1:], kind[:-1], out=cut[1:])
        cut |= kind == _DIGIT
        rows = offsets[:-1][offsets[:-1] < len(data)]
        cut[rows] = True
        blank = kind == _BLANK
        word = blank.copy()
        word[1:] |= blank[:-1]
        word[0] = True
        word[rows] = True
        lower = self.lower[data]
        high = lead[data[lead + 1] <= 0x9E] + 1
        lower[high] += 0x20
        # Words that stay one piece, as they are; few bytes.
        words = np.append(np.flatnonzero(word), len(data))
        whole = np.unique(np.searchsorted(words, np.flatnonzero(kind == _ODD), "right") - 1)
        sizes = words[whole + 1] - words[whole]
        odd = np.arange(sizes.sum()) + np.repeat(words[whole] - np.cumsum(sizes) + sizes, sizes)
        cut[odd] = word[odd]
        lower[odd] = data[odd]
        starts = np.flatnonzero(cut)
        bounds = np.append(starts, len(data))
        array = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(lower)]
        ).dictionary_encode()
        distinct = array.dictionary.to_pylist()
        clean = [b"" if p[0] <= 32 and p.isspace() else p for p in distinct]
        new = [p for p in clean if p not in self.known]
        if new:
            self._learn(list(dict.fromkeys(new)))
        place = np.array([self.known[p] for p in clean], np.int32)
        own = place[array.indices.to_numpy()]
        first, counts = self.bounds[own], self.bounds[own + 1] - self.bounds[own]
        total = np.zeros(len(counts) + 1, np.int32)
        np.cumsum(counts, out=total[1:])
        at = np.arange(total[-1], dtype=np.int32) + np.repeat(first - total[:-1], counts)
        return self.ids[at], total[np.searchsorted(starts, offsets)].astype(np.int64)


def _worker_encoder(path: str) -> PieceEncoder:
    """The encoder that this Python worker keeps for all its tasks."""
    name = "_hitledger_worker_encoders"
    kept = sys.modules.setdefault(name, types.ModuleType(name))
    if getattr(kept, "path", None) != path:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one text at a time; threads would hold memory of their own
        from tokenizers import Tokenizer

        kept.path, kept.encoder = path, PieceEncoder(Tokenizer.from_file(path))
    return kept.encoder


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> None:
    """Encodes every text of ``docs`` (doc_id long, text) and writes the ids to ``path``.

    Files have doc_id, ids (array<int>, ``end_id`` last), n_tokens long, part int
    and part_start long: the file's number and the ids of its earlier documents.
    Files are numbered, and rows ordered in them, by doc_id (null first), then
    by text; a null or empty text has the end id alone, repeated rows follow each other,
    an empty table makes files without rows. Other columns are not written.
    """
    ordered = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("tie"))
        .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker_encoder(tokenizer)
        number, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part, data, offsets in pieces(batch, "text", TEXT_BYTES):
                ids, bounds = encoder.encode(data, offsets)
                rows = np.arange(part.num_rows)
                ids, bounds = np.insert(ids, bounds[1:], end_id).astype(np.int32), bounds + np.append(rows, part.num_rows)
                counts = np.diff(bounds)
                yield pa.record_batch(
                    [
                        part.column(0), pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(ids)),
                        pa.array(counts, pa.int64()), pa.array(np.full(part.num_rows, number, np.int32)),
                        pa.array(done + bounds[:-1], pa.int64()),
                    ],
                    names=["doc_id", "ids", "n_tokens", "part", "part_start"],
                )
                done += int(bounds[-1])

    ids = ordered.mapInArrow(tidy(ordered.sparkSession, encode), TOKENS)
    ids.write.options(**FILE_OPTIONS, **{"parquet.block.size": str(ROW_GROUP_BYTES)}).parquet(path)


TOKENS = "doc_id long, ids array<int>, n_tokens long, part int, part_start long"


def read_tokens(spark: SparkSession, path: str, columns: tuple[str, ...] = ("doc_id", "ids"), low: int | None = None, high: int | None = None) -> DataFrame:
    """Chosen columns of a token file, for doc_ids from ``low`` to ``high`` if given.

    Without ``ids`` no token is read; bounds skip files, row groups and pages.
    """
    rows = spark.read.schema(TOKENS).parquet(path)
    if low is not None:
        rows = rows.where(F.col("doc_id") >= low)
    if high is not None:
        rows = rows.where(F.col("doc_id") <= high)
    return rows.select(*columns)


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """What a token file holds of each document: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is over
    its ids as little-endian 32-bit integers.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1)
            values = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            bounds = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))])
            sums = [zlib.crc32(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.record_batch(
                [batch.column(0), batch.column(2), batch.column(3), batch.column(4), pa.array(sums, pa.int64())],
                names=["doc_id", "n_tokens", "part", "part_start", "ids_crc32"],
            )

    rows = read_tokens(spark, path, ("doc_id", "ids", "n_tokens", "part", "part_start"))
    rows = rows.mapInArrow(tidy(rows.sparkSession, digest), "doc_id long, n_tokens long, part int, part_start long, ids_crc32 long")
    # One row for each file, whose number the writer's partitions bound.
    parts = read_tokens(spark, path, ("part", "n_tokens")).groupBy("part").agg(F.sum("n_tokens").alias("held"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    start = (F.col("base") + F.col("part_start")).alias("start")
    return rows.join(F.broadcast(parts), "part").select("doc_id", start, "n_tokens", "ids_crc32")


