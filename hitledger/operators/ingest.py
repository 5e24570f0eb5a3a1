"""From raw lines to rows fit for publishing."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.functions.times import bucket_of, parse_param, text_of
from hitledger.sources.lines import parse_tolerant

# Fixed value: a row may be up to this much older than its load time.
LATENESS = timedelta(hours=2)
#: Houses whose task counts become literals of the plan, and directories of houses whose tasks are told one by one.
MOST_HOUSES = 5_000


def drop_late(parsed: DataFrame, load_time: str | datetime) -> DataFrame:
    """Rows newer than two hours before the load time.

    The load time is when the batch was collected, not the newest event, so this
    is not a watermark. There is no upper bound. Rejects and unreadable times
    carry "-1" or "0", which sort below any date, and are dropped here too.
    """
    return parsed.where(F.col("acctime") > text_of(parse_param(load_time) - LATENESS))


def drop_late_by(parsed: DataFrame, load_time: Column) -> DataFrame:
    """The same cut where every row brings its own load time (``timestamp_ntz``)."""
    cut = (load_time - F.expr(f"interval {int(LATENESS.total_seconds())} seconds")).cast("string")
    return parsed.where(F.col("acctime") > cut)


def ingest_rows(
    lines: DataFrame, load_time: str | datetime, batch_id: str, zone: str | None = None
) -> DataFrame:
    """Rows of one batch, labelled with it, ready for ``publish``."""
    rows = drop_late(parse_tolerant(lines, zone=zone), load_time)
    return rows.withColumn("batch", F.lit(batch_id))


def sized(
    rows: DataFrame, tasks: DataFrame, load_time: str | datetime, most: int = MOST_HOUSES, by: Sequence[str] | None = None
) -> DataFrame:
    """Rows dealt to write tasks: of each house ``current_hour`` tasks for the hour of the load time, ``previous_hour`` for all others.

    ``tasks`` is (hid, current_hour, previous_hour), as of :func:`hitledger.operators.compaction.ingest_parallelism`. Rows of a
    house and hour go to its tasks in turn, so a hot house is spread as its bytes ask for. Houses without a line in
    ``tasks`` share as many tasks as an average house has. With more than ``most`` houses Spark sizes the tasks.

    With ``by`` the rows of every directory (of these levels) are counted first, and a house's tasks are dealt to its directories
    by their rows, so that a task writes one directory and not a piece of each.
    """
    counts = tasks.select("hid", "current_hour", "previous_hour").take(most + 1)
    if not counts or len(counts) > most:
        return rows.hint("rebalance", "hid", "d", "h")
    begin, starts = 0, {}
    for row in counts:
        starts[row.hid] = (begin, row.current_hour, row.previous_hour)
        begin += row.current_hour + row.previous_hour
    rest = max(1, begin // len(counts))
    bucket = bucket_of(parse_param(load_time))
    current = (F.col("d") == bucket["d"]) & (F.col("h") == bucket["h"])
    pairs = [F.lit(x) for hid, own in starts.items() for x in (hid, F.array(*map(F.lit, own)))]
    own = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("hid").cast("string")), F.array(F.lit(begin), F.lit(rest), F.lit(0)))
    older = ~F.coalesce(current, F.lit(False)) & (own[2] > 0)
    turn = F.monotonically_increasing_id()
    if by is not None:
        keys = [F.col("hid").cast("string").alias("_hid"), F.coalesce(current, F.lit(False)).alias("_current")]
        keys += [F.col(c).alias(f"_{c}__") for c in by]
        names = rows.select(keys).columns
        held = rows.select(keys).groupBy(names).agg(F.count(F.lit(1)).alias("n")).take(most + 1)
        if 0 < len(held) <= most:
            return _by_directory(rows, keys, held, starts, rest, turn)
    slot = own[0] + F.when(older, own[1] + turn % own[2]).otherwise(turn % own[1])
    return rows.withColumn("_slot", slot.cast("int")).repartitionById(begin + rest, F.col("_slot")).drop("_slot")


def _by_directory(rows: DataFrame, keys: list[Column], held: list, starts: dict, rest: int, turn: Column) -> DataFrame:
    """Rows dealt to tasks of one directory each.

    Tasks for earlier hours go to the directories by their rows, one at least; the hour of the load time gets all of its tasks
    unless it has a smaller part of the house's rows than of its tasks.
    """
    total: dict[str, list[int]] = {}  # of a house: rows of earlier hours, rows of the current one
    for row in held:
        total.setdefault(row["_hid"], [0, 0])[row["_current"]] += row["n"]
    begin, deals = 0, []
    others = sum(row["n"] for row in held if row["_hid"] not in starts)
    for row in sorted(held, key=str):
        if row["_hid"] not in starts:
            count = -(-rest * row["n"] // others)
            deals.append((*row[:-1], begin, count))
            begin += count
            continue
        (_, now, before), (older, newest) = starts[row["_hid"]], total[row["_hid"]]
        if row["_current"]:
            count = min(-(-now * row["n"] // newest), -(-(now + before) * row["n"] // (older + newest)))
        else:
            count = -(-(before or now) * row["n"] // older)
        deals.append((*row[:-1], begin, count))
        begin += count
    names = rows.select(keys).columns
    schema = ", ".join(f"`{name}` {kind}" for name, kind in rows.select(keys).dtypes)
    told = rows.sparkSession.createDataFrame(deals, f"{schema}, _first int, _tasks int").alias("told")
    same = " and ".join(f"own.`{name}` <=> told.`{name}`" for name in names)
    # Bounded by the count of directories before. Rows of input that came meanwhile have no directory there.
    dealt = rows.select("*", *keys, turn.alias("_turn")).alias("own").join(F.broadcast(told), F.expr(same), "left")
    slot = F.coalesce(F.col("_first") + F.col("_turn") % F.col("_tasks"), F.lit(begin))
    return dealt.select(*(F.col(f"own.`{c}`") for c in rows.columns), slot.cast("int").alias("_slot")).repartitionById(begin + 1, F.col("_slot")).drop("_slot")
