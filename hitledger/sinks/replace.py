"""Any number of partitions of a table replaced in one step.

State lies under ``<table>/_replace/<id>``, which scans skip:

1. ``new``: the rows are written there, by the table's partition levels.
2. ``gone``: the directories of the table that they replace.
3. mark ``_shown``, one file made: from now on readers take the new rows and
   nothing from the directories that are gone.
4. the directories that are gone are deleted; the mark is renamed to ``_moving``:
   readers take whatever is in either tree.
5. new directories move into the table, whole houses or days where nothing is left of them there; the state goes.

:func:`read_partitions` goes by these marks, so that a reader sees the old rows or
the new ones, never some of each, also after a crash; a scan that began
before step 4 or 5 may fail on a missing file and is to be repeated. A write that finds an earlier one
stopped finishes it after its mark, and forgets it before. One write to a table at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.workspace import Files, at_once, matching_paths

WORK, NEW, GONE, SHOWN, MOVING = "_replace", "new", "gone", "_shown", "_moving"
T = TypeVar("T")


def replace_partitions(spark: SparkSession, path: str, write: Callable[[str], T], stale: Sequence[str] | None, depth: int) -> T:
    """Show what ``write(folder)`` writes in place of the directories that match ``stale``.

    ``stale`` are globs below ``path``; all that match go, whether there are new rows for them or not.
    Without it, the directories that were written are replaced, ``depth`` levels deep.
    """
    finish_replacing(spark, path)
    files, work = Files(spark, path), f"{path}/{WORK}/{uuid.uuid4().hex[:12]}"
    result = write(f"{work}/{NEW}")
    if stale is None:
        gone = [folder for folder in _leaves(files, f"{work}/{NEW}", depth) if files.exists(f"{path}/{folder}")]
    else:
        start = len(files.qualified(path)) + 1
        gone = sorted({found[start:] for glob in stale for found in files.glob(f"{path}/{glob}")})
    files.write_text(f"{work}/{GONE}", "\n".join(gone))
    files.make_marker(f"{work}/{SHOWN}")
    finish_replacing(spark, path)
    return result


def _leaves(files: Files, root: str, depth: int) -> Iterator[str]:
    for name in files.folders(root):
        if depth == 1:
            yield name
        else:
            yield from (f"{name}/{below}" for below in _leaves(files, f"{root}/{name}", depth - 1))


def finish_replacing(spark: SparkSession, path: str) -> None:
    """Carries on from the mark that a stopped write left, if any."""
    files = Files(spark, path)
    if not files.exists(f"{path}/{WORK}"):
        return
    for mark in files.glob(f"{path}/{WORK}/*/{SHOWN}"):
        work = mark.rsplit("/", 1)[0]
        at_once([lambda folder=folder: files.remove(f"{path}/{folder}") for folder in _gone(files, work)])
        files.move(mark, f"{work}/{MOVING}")
    for mark in files.glob(f"{path}/{WORK}/*/{MOVING}"):
        work = mark.rsplit("/", 1)[0]
        at_once([lambda pair=pair: files.move(*pair) for pair in _moves(files, f"{work}/{NEW}", path)])
    files.remove(f"{path}/{WORK}")


def _gone(files: Files, work: str) -> list[str]:
    return [line for line in files.read_text(f"{work}/{GONE}").splitlines() if line]


def _moves(files: Files, source: str, target: str) -> Iterator[tuple[str, str]]:
    """The highest directories that can move whole."""
    for name in files.folders(source):
        one, two = f"{source}/{name}", f"{target}/{name}"
        if not files.exists(two):
            yield one, two
        elif files.folders(one):
            yield from _moves(files, one, two)
        else:  # a directory of files, moved into one that was made meanwhile
            yield from ((file, f"{two}/{file.rsplit('/', 1)[1]}") for file in files.glob(f"{one}/[!_.]*"))


def read_partitions(
    spark: SparkSession, path: str, globs: Sequence[str], scan: Callable[[str, list[str]], DataFrame], levels: Sequence[str]
) -> DataFrame:
    """``scan(root, globs)`` over the table, with the rows of a write under way in place of those they replace."""
    files, states = Files(spark, path), None
    while states != (now := {m: files.glob(f"{path}/{WORK}/*/{m}") for m in (SHOWN, MOVING)}):
        states = now
        # Staged directories are listed first: one that moves meanwhile is then found twice (and its scan fails), never missed.
        staged = [scan(f"{mark.rsplit('/', 1)[0]}/{NEW}", list(globs)) for marks in now.values() for mark in marks]
        rows = scan(path, list(globs))
    for mark in states[SHOWN]:
        rows = _without(rows, _gone(files, mark.rsplit("/", 1)[0]), levels)
    for new in staged:
        rows = rows.unionByName(new)
    return rows


def _without(rows: DataFrame, gone: list[str], levels: Sequence[str]) -> DataFrame:
    if not gone:
        return rows
    values = [dict(level.split("=", 1) for level in folder.split("/")) for folder in gone]
    table = rows.sparkSession.createDataFrame([tuple(v.get(name) for name in levels) for v in values], ", ".join(f"`{n}` string" for n in levels))
    same = [f"(g.`{n}` is null or g.`{n}` = cast(r.`{n}` as string))" if n != levels[0] else f"g.`{n}` = cast(r.`{n}` as string)" for n in levels]
    return rows.alias("r").join(table.alias("g"), F.expr(" and ".join(same)), "left_anti").select(rows.columns)


def scan_paths(spark: SparkSession, root: str, globs: Sequence[str]) -> list[str]:
    return matching_paths(spark, [f"{root}/{glob}" if glob else root for glob in globs])
