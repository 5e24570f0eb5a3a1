"""URL filters: rules, and a path-template tree for what no rule covers.

Rules by host and path prefix judge first; what they judge labels the rest. Of
each host the paths form a tree of segments. Level by level a segment keeps a
branch of its own only where its labels differ from its siblings', however few
pages it has, and also where the siblings have no labels; such branches that are alike among themselves are merged, and all
others are one wildcard branch. A template is rejected when the share of blocked
among its labelled pages, smoothed, is high.

All of it is DataFrame code. Pages are shuffled twice, on host and path shape.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.llm.stages import Stages, adds, maybe_broadcast

#: Segments below this depth are one tail.
DEPTH = 4
#: Templates up to this number may be broadcast.
BROADCAST_TEMPLATES = 200_000


@dataclass(frozen=True)
class Rule:
    """``verdict`` for pages of ``host`` and its subdomains whose path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Tree:
    """``similar``: standard errors within which two block rates count as one; ``purity``: the smoothed block rate
    that rejects; ``prior``: pages added to both sides."""

    similar: float = 3.0
    purity: float = 0.9
    prior: float = 1.0


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the host's end to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null. The rules become one expression."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the longest is asked first
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def shape_of(path: Column) -> Column:
    """The path with segments that are variable by their form as ``*``: numbers, hex strings, with or without a suffix."""
    return F.regexp_replace(path, r"(?<=/)(?:[0-9]+|[0-9a-fA-F-]{16,})(?=/|\.[A-Za-z0-9]{1,5}\z|\z)", "*")


def _segment(shape: Column, level: int) -> Column:
    parts = F.split(shape, "/")  # the first part is what precedes the first slash
    tail = F.array_join(F.slice(parts, level + 1, F.greatest(F.size(parts), F.lit(1))), "/") if level == DEPTH else None
    return F.when(F.size(parts) > level, tail if tail is not None else F.get(parts, F.lit(level)))


def _apart(tree: Tree, blocked: Column, labelled: Column, all_blocked: Column, all_labelled: Column) -> Column:
    """Whether a branch's block rate differs from that of the others in ``all`` by more than ``tree.similar`` standard errors.

    False for a branch without labels, true where no other one has labels.
    """
    others, pooled = all_labelled - labelled, all_blocked / all_labelled
    gap = F.pow(blocked / labelled - (all_blocked - blocked) / others, F.lit(2.0))
    noise = pooled * (1 - pooled) * (1 / labelled + 1 / others) * tree.similar**2
    return F.when(labelled == 0, F.lit(False)).when(others == 0, F.lit(True)).otherwise(gap > noise)


def templates(stages: Stages, shapes: DataFrame, tree: Tree) -> DataFrame:
    """``shapes`` (host, shape, n, blocked, allowed) with each one's ``template``.

    In each level a branch is (host, template so far, next segment). A branch
    whose block rate differs from its siblings' is kept at any number of pages, so
    that its labels do not judge siblings without labels; branches kept on the same side (above or below their siblings) that do
    not differ from each other become one, ``*+`` or ``*-``; the rest becomes ``*``.
    """
    rows = shapes.withColumn("template", F.lit(""))
    node = ["host", "template"]
    for level in range(1, DEPTH + 1):
        rows = rows.withColumn("segment", _segment(F.col("shape"), level))
        branch = rows.where("segment is not null").groupBy(*node, "segment").agg(
            F.sum("blocked").alias("blocked"), F.sum(F.col("blocked") + F.col("allowed")).alias("labelled")
        )
        branch = stages.write(branch, "branches")
        own = (F.col("blocked"), F.col("labelled"))
        sums = lambda to: (F.sum("blocked").alias(f"{to}_blocked"), F.sum("labelled").alias(f"{to}_labelled"))
        kept = branch.join(branch.groupBy(node).agg(*sums("all")), node).where(_apart(tree, *own, F.col("all_blocked"), F.col("all_labelled")))
        above = F.col("blocked") * F.col("all_labelled") >= F.col("all_blocked") * F.col("labelled")
        kept = stages.write(kept.withColumn("side", F.when(above, "*+").otherwise("*-")), "kept")
        alone = _apart(tree, *own, F.col("side_blocked"), F.col("side_labelled"))
        name = F.when(alone, F.col("segment")).otherwise(F.col("side"))
        kept = kept.join(kept.groupBy(*node, "side").agg(*sums("side")), [*node, "side"]).select(*node, "segment", name.alias("name"))
        step = F.when(F.col("segment").isNull(), F.lit("")).otherwise(F.concat(F.lit("/"), F.coalesce("name", F.lit("*"))))
        rows = rows.join(kept, [*node, "segment"], "left").withColumn("template", F.concat("template", step)).drop("segment", "name")
        rows = stages.write(rows, "shapes")
    return rows


@adds("host", "path", "rule", "verdict", "template", "purity", hidden=("_ruled", "_shape"))
def judge(pages: DataFrame, rules: Sequence[Rule], tree: Tree = Tree()) -> DataFrame:
    """``pages`` with host, path, rule, verdict (``block`` or ``allow``), template and purity.

    ``pages`` needs url; its columns of these names give way. A url that is null or
    without ``://`` has an empty host and path and is judged like any other (no
    rule fits it). Repeated rows get the same verdict; templates are learned from
    all rows. Without a rule, a page is blocked if (blocked + prior) /
    (labelled + 2 * prior) of its template reaches ``tree.purity``; a template
    without labels is allowed. Purity is null where a rule decides.
    """
    stages = Stages(pages.sparkSession, "url-filter")
    read = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    read = read.withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))})
    read = read.withColumn("_ruled", rule_of(F.col("host"), F.col("path"), rules))
    counts = lambda verdict: F.count(F.when(F.col("_ruled.verdict") == verdict, F.lit(1)))
    shapes = read.groupBy("host", shape_of(F.col("path")).alias("shape")).agg(
        F.count(F.lit(1)).alias("n"), counts("block").alias("blocked"), counts("allow").alias("allowed")
    )
    known = templates(stages, stages.write(shapes, "shapes"), tree)
    purity = (F.sum("blocked") + tree.prior) / (F.sum("blocked") + F.sum("allowed") + 2 * tree.prior)
    purities = known.groupBy("host", "template").agg(purity.alias("purity"))
    by_shape = known.select("host", "shape", "template").join(purities, ["host", "template"])
    by_shape = stages.write(by_shape, "purities")
    found = read.withColumn("_shape", shape_of(F.col("path"))).alias("p").join(
        maybe_broadcast(by_shape, BROADCAST_TEMPLATES).alias("t"), F.expr("p.host = t.host and p._shape = t.shape")
    )
    ruled = F.col("p._ruled").isNotNull()
    by_tree = F.when(F.col("t.purity") >= tree.purity, F.lit("block")).otherwise(F.lit("allow"))
    return found.select(
        *[F.col(f"p.{c}") for c in pages.columns], F.col("p.host"), F.col("p.path"), F.col("p._ruled.rule").alias("rule"),
        F.coalesce(F.col("p._ruled.verdict"), by_tree).alias("verdict"), F.col("t.template"),
        F.when(~ruled, F.col("t.purity")).alias("purity"),
    )
