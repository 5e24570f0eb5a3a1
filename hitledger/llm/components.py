"""Connected components by repeated contraction, all as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.llm.stages import Stages


def components(stages: Stages, edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a long, b long); component is the smallest node in it.

    Each round sends every node to the lowest of itself and its neighbours, jumps
    once along these pointers, and keeps the edges between different targets.
    Ids serve as order in even rounds, which ends stars at once; in odd rounds
    hashes do, which shortens long chains whatever their ids are. Nodes of
    finished rounds are only ever joined by key; no list of neighbours is made.
    """
    hops = []
    left = stages.write(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    while not left.isEmpty():
        both = left.select(F.col("a").alias("v"), F.col("b").alias("u")).union(left.select("b", "a"))
        if len(hops) % 2:
            best = both.groupBy("v").agg(F.min_by("u", F.struct(F.xxhash64("u"), "u")).alias("u"))
            lower = F.struct(F.xxhash64("u"), F.col("u")) < F.struct(F.xxhash64("v"), F.col("v"))
        else:
            best = both.groupBy("v").agg(F.min("u").alias("u"))
            lower = F.col("u") < F.col("v")
        hop = stages.write(best.select("v", F.when(lower, F.col("u")).otherwise(F.col("v")).alias("p")), "pointers")
        onward = hop.select(F.col("v").alias("p"), F.col("p").alias("q"))
        hop2 = stages.write(hop.join(onward, "p").select("v", F.col("q").alias("p")), "jumps")
        ends = left
        for side in ("a", "b"):
            ends = ends.join(hop2.select(F.col("v").alias(side), F.col("p").alias(f"{side}2")), side)
        kept = ends.where("a2 <> b2").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct()
        rest = stages.write(kept, "edges")
        stages.drop(left, hop)
        hops.append(hop2)
        left = rest
    stages.drop(left)
    if not hops:
        return stages.spark.createDataFrame([], "node long, component long")
    found = hops[0].select(F.col("v").alias("node"), F.col("p").alias("root"))
    for hop in hops[1:]:
        onward = hop.select(F.col("v").alias("root"), "p")
        found = found.join(onward, "root", "left").select("node", F.coalesce("p", "root").alias("root"))
    found = stages.write(found, "roots")
    stages.drop(*hops)
    lowest = found.groupBy("root").agg(F.min("node").alias("component"))
    return stages.write(found.join(lowest, "root").select("node", "component"), "components")
