"""Merkle fixity audit of WARC archives and their replicas.

Every record is hashed; runs of ``FAN_OUT`` records in offset order are hashed
into a node, runs of nodes into a node of the next level, up to one root an
archive. Two replicas are compared from their roots down, and only branches
that differ are looked at further, so an intact archive costs one comparison and a damaged
record as many as the tree has levels.

All of it is DataFrame code; no task holds more than one node's children.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitledger.llm.stages import Stages

FAN_OUT = 16


def response_record(url: Column, payload: Column) -> Column:
    """A WARC response record as text: headers, payload, two line ends. Null url or payload: empty."""
    url, payload = F.coalesce(url, F.lit("")), F.coalesce(payload, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), url,
        F.lit("\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"), payload, F.lit("\r\n\r\n"),
    )


def laid_out(records: DataFrame, order: str) -> DataFrame:
    """``records`` (archive, record text or binary) with their place in their archive.

    Gives archive, place long (from 0, by ``order``, then by hash), start and end bytes (end
    exclusive), sha256 of the record, and ``order``. An archive's hashes and
    lengths are ordered in one task, its records' bytes are not: archives are to
    be files of bounded size, as WARC files are.
    """
    hashed = records.select("archive", order, F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("sha256"))
    inside = Window.partitionBy("archive").orderBy(F.col(order).asc_nulls_first(), "sha256")
    end = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return hashed.select(
        "archive", (F.row_number().over(inside) - 1).cast("long").alias("place"), order,
        (end - F.col("length")).alias("start"), end.alias("end"), "sha256",
    )


def tree(stages: Stages, leaves: DataFrame, largest: int) -> list[DataFrame]:
    """Levels of nodes (archive, place, start, end, sha256), leaves first, one root for each archive last.

    As deep as an archive with a place ``largest`` needs; every level hashes anew, so only trees of equal depth compare.
    """
    level = leaves
    levels = [level]
    while largest > 0:
        largest //= FAN_OUT
        child = F.struct("place", "start", "end", "sha256")
        nodes = level.groupBy("archive", F.floor(F.col("place") / FAN_OUT).cast("long").alias("place")).agg(
            F.array_sort(F.collect_list(child)).alias("children")
        )
        level = stages.write(nodes.select(
            "archive", "place", F.get("children", F.lit(0))["start"].alias("start"), F.element_at("children", -1)["end"].alias("end"),
            F.sha2(F.array_join(F.transform("children", lambda c: c["sha256"]), ""), 256).alias("sha256"),
        ), "nodes")
        levels.append(level)
    return levels


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Where two replicas differ, and the verdict on every archive.

    ``first`` and ``second`` come from :func:`laid_out`; archive may be null (one
    archive like any other) and has the same type in both. Gives one row for
    each archive in either (level = "archive") and one for each record that
    differs (level = "record"): archive, level, place, start, end (of the first
    replica, else of the second), first_sha256, second_sha256 (null: not there)
    and status: same, changed, missing (in the second) or extra.

    Records are matched by their place in the archive. Empty records and repeated
    records are records like any other; two empty tables give no rows.
    """
    stages = Stages(first.sparkSession, "fixity")
    columns = ["archive", "place", "start", "end", "sha256"]
    leaves = [stages.write(side.select(columns), "leaves") for side in (first, second)]
    largest = max(side.agg(F.max("place")).first()[0] or 0 for side in leaves)
    trees = [tree(stages, side, largest) for side in leaves]

    def compare(number: int, parents: DataFrame | None) -> DataFrame:
        sides = []
        for side, name in enumerate("ab"):
            nodes = trees[side][number]
            if parents is not None:
                nodes = nodes.withColumn("parent", F.floor(F.col("place") / FAN_OUT).cast("long")).alias("n").join(
                    parents.alias("p"), F.expr("n.archive <=> p.archive and n.parent = p.place"), "left_semi"
                ).drop("parent")
            sides.append(nodes.alias(name))
        both = sides[0].join(sides[1], F.expr("a.archive <=> b.archive and a.place = b.place"), "full")
        pick = lambda c: F.coalesce(f"a.{c}", f"b.{c}").alias(c)
        status = (
            F.when(F.col("b.sha256").isNull(), "missing").when(F.col("a.sha256").isNull(), "extra")
            .when(F.col("a.sha256") != F.col("b.sha256"), "changed").otherwise("same")
        )
        return both.select(
            *map(pick, ("archive", "place", "start", "end")), F.col("a.sha256").alias("first_sha256"),
            F.col("b.sha256").alias("second_sha256"), status.alias("status"),
        )

    roots = stages.write(compare(len(trees[0]) - 1, None), "roots")
    differing = roots.where("status <> 'same'")
    for number in range(len(trees[0]) - 2, -1, -1):
        found = compare(number, differing.select("archive", "place"))
        differing = stages.write(found.where("status <> 'same'"), "differing")
    report = ["archive", "level", "place", "start", "end", "first_sha256", "second_sha256", "status"]
    return roots.withColumn("level", F.lit("archive")).select(report).union(
        differing.withColumn("level", F.lit("record")).select(report)
    )
