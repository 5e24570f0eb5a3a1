"""Fill-in-middle: a text cut at two ranks, its parts put in another order.

Ranks count units of a text (code points, or words with the blanks before
them). An indexable skip list leads from a rank to its place: its lowest lane
holds every unit, each higher lane about one node in sixteen of the lane below,
and every link carries its width in units, in code points and in bytes. A
descent adds up widths and never goes beyond the rank, so it ends at the unit
of that rank with its code-point and byte offset, whatever the units are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.llm.textbytes import WHITE, byte_table, pieces, tidy

#: One node in so many goes up a lane.
FAN = 16
#: Marks of the parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
POINTS, WORDS = "points", "words"


@dataclass
class Lane:
    """Nodes of one lane over all rows of a batch; ``down`` is a node's place in the lane below."""

    down: np.ndarray
    units: np.ndarray
    points: np.ndarray
    bytes: np.ndarray


def _unit_starts(data: np.ndarray, offsets: np.ndarray, units: str) -> np.ndarray:
    """Whether a unit begins at each byte; a row's first byte always begins one."""
    if units == POINTS:
        start = (data & 0xC0) != 0x80
    elif units == WORDS:
        blank = byte_table(WHITE, lower=False)[data] == 32
        start = blank.copy()
        start[1:] &= ~blank[:-1]  # blanks before a word belong to it
    else:
        raise ValueError(f"unknown units {units!r}")
    start[offsets[:-1][offsets[:-1] < len(data)]] = True
    return start


def _narrow(widths: np.ndarray) -> np.ndarray:
    return widths.astype(np.min_scalar_type(int(widths.max()) if len(widths) else 0))


class SkipList:
    """Lanes over the units of all rows of a batch; a row's first unit is in every lane."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, units: str = POINTS, seed: int = 7):
        at = np.flatnonzero(_unit_starts(data, offsets, units))
        sizes = np.diff(offsets)
        self.heads = np.searchsorted(at, offsets[:-1])  # rows without bytes: the next row's head, never used
        self.filled = sizes > 0
        self.counts = np.diff(np.append(self.heads, len(at)))
        width = np.diff(np.append(at, len(data)))
        if units == POINTS:
            points = np.ones(len(at), np.uint8)
        else:
            points = _narrow(np.add.reduceat((data & 0xC0) != 0x80, at, dtype=np.int64)) if len(at) else np.zeros(0, np.uint8)
        ones = np.ones(len(at), np.uint8)
        self.lanes = [Lane(np.arange(len(at)), ones, points, _narrow(width))]
        heads, rng = self.heads[self.filled], np.random.default_rng(seed)
        while len(self.lanes[-1].units) > FAN * max(1, len(heads)):
            low = self.lanes[-1]
            n = len(low.units)
            # Coins of one in FAN, thrown as gaps between the nodes that go up.
            gaps = rng.geometric(1 / FAN, n // FAN + 8 * int(np.sqrt(n)) + 8)
            up = np.cumsum(gaps)
            up = np.union1d(up[up < n], heads)
            self.lanes.append(Lane(up, *(np.add.reduceat(w, up, dtype=np.int64) for w in (low.units, low.points, low.bytes))))
            heads = np.searchsorted(up, heads)
        self.top = np.zeros(len(sizes), np.int64)
        self.top[self.filled] = heads

    def find(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code points and bytes before the unit of each row's rank (0 to the row's count)."""
        units, points, bytes_ = (np.zeros(len(ranks), np.int64) for _ in range(3))
        going = np.flatnonzero(self.filled & (ranks > 0))
        node = self.top.copy()
        for lane in reversed(self.lanes):
            moving = going
            while len(moving):
                at = node[moving]
                width = lane.units[np.minimum(at, len(lane.units) - 1)]
                fits = units[moving] + width <= ranks[moving]
                moving, at = moving[fits], at[fits]
                units[moving] += lane.units[at]
                points[moving] += lane.points[at]
                bytes_[moving] += lane.bytes[at]
                node[moving] = at + 1
                moving = moving[units[moving] < ranks[moving]]
            going = going[units[going] < ranks[going]]
            node[going] = lane.down[node[going]]
        return points, bytes_


def _drawn(doc_id: str) -> list[Column]:
    """Four unsigned numbers out of the id's digest (a null id: as empty text)."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(digest.substr(8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, plain_percent: int = 10, spm_percent: int = 20, units: str = POINTS) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (code points) and output of every row of ``docs`` (doc_id, text).

    The form is drawn from doc_id: ``plain`` in ``plain_percent`` of the rows (the text as it is), else ``spm`` in
    ``spm_percent`` or ``psm``; so are the two ranks of the cuts. A null text counts as empty; an empty text, and
    one that holds a mark, is plain. Plain rows have null prefix_chars and middle_chars. Repeated rows are cut alike; a null
    doc_id draws as an empty one. Other columns of ``docs`` are not looked at and not returned.
    """
    text = F.coalesce("text", F.lit(""))
    drawn = docs.select("doc_id", text.alias("text"), F.array(*_drawn("doc_id")).alias("h")).select(
        "doc_id", "text", *[F.get("h", F.lit(i)).alias(f"h{i + 1}") for i in range(4)]
    )
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    rows = drawn.select("doc_id", "text", "h1", "h2", form.alias("form"))
    before, after, middle_mark = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch, "text"):
                lanes = SkipList(data, offsets, units)
                n = lanes.counts
                one, two = (part.column(c).to_numpy() % (n + 1) for c in (2, 3))
                (low_p, low_b), (high_p, high_b) = lanes.find(np.minimum(one, two)), lanes.find(np.maximum(one, two))
                forms, view, outputs = part.column(4).to_pylist(), data.data if len(data) else b"", []
                for kind, start, a, b, end in zip(forms, offsets[:-1].tolist(), low_b.tolist(), high_b.tolist(), offsets[1:].tolist()):
                    prefix, middle, suffix = view[start : start + a], view[start + a : start + b], view[start + b : end]
                    if kind == "plain":
                        outputs.append(bytes(view[start:end]))
                    elif kind == "psm":
                        outputs.append(b"".join([before, prefix, after, suffix, middle_mark, middle]))
                    else:
                        outputs.append(b"".join([after, suffix, before, prefix, middle_mark, middle]))
                whole = np.array([kind == "plain" for kind in forms], bool)
                yield pa.record_batch(
                    [
                        part.column(0), pa.array(n, pa.int64()), part.column(4), pa.array(low_p, pa.int64(), mask=whole),
                        pa.array(high_p - low_p, pa.int64(), mask=whole), pa.array(outputs, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    schema = "n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(tidy(rows.sparkSession, cut), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {schema}")


def restored(output: str = "output", form: str = "form") -> Column:
    """The text again, from an output and its form alone."""
    out = F.col(output)
    place = lambda mark: F.locate(mark, out)
    piece = lambda first, last: F.substring(out, first, last - first)
    end = F.length(out) + 1
    after_mark = lambda mark: place(mark) + 3
    middle = piece(after_mark(MIDDLE), end)
    psm = F.concat(piece(after_mark(PREFIX), place(SUFFIX)), middle, piece(after_mark(SUFFIX), place(MIDDLE)))
    spm = F.concat(piece(after_mark(PREFIX), place(MIDDLE)), middle, piece(after_mark(SUFFIX), place(PREFIX)))
    return F.when(F.col(form) == "plain", out).when(F.col(form) == "psm", psm).otherwise(spm)
