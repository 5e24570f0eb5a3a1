"""Line dedup by a log-template tree of fixed depth.

Lines go down a tree: by their number of tokens, then by their leading tokens,
with tokens that hold digits as wildcards. In a leaf that several documents
share, a token is a constant of its position if it is frequent there, else a
variable field. Lines that agree in the constants have one template; a line with
too few constants is a template by itself, so that lines repeated word for word
count however crowded their leaf is. Lines of templates that recur across
documents are dropped.

All of it is DataFrame code. Only lines in shared leaves go beyond the first
count, and only their token hashes are shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.llm.stages import Stages, adds, maybe_broadcast

#: Leaves up to this number may be broadcast.
BROADCAST_LEAVES = 200_000


@dataclass(frozen=True)
class Parse:
    """``leading``: depth of the tree below the token count; ``min_docs``: documents that make a template recur;
    ``frequent``: share of a leaf's lines that makes a token constant; ``fixed``: share of a template's tokens that must be constant."""

    leading: int = 3
    min_docs: int = 4
    frequent: float = 0.1
    fixed: float = 0.5


BLANK = r"[\x20\x09-\x0D]"


def tokens_of(line: Column) -> Column:
    """Tokens between blanks of a line without blanks at its ends; those with a digit are ``*`` from the start."""
    masked = F.regexp_replace(line, r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*", "*")
    return F.split(F.when(line.rlike("[0-9]"), masked).otherwise(line), f"{BLANK}+")


def _lines(docs: DataFrame, parse: Parse) -> DataFrame:
    """(doc_id, at, leaf, tokens) of every line that has a token."""
    lines = docs.where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    lines = lines.select("doc_id", "at", F.btrim("line", F.lit(" \t\x0b\x0c\r")).alias("line")).where("line <> ''")
    lines = lines.select("doc_id", "at", tokens_of(F.col("line")).alias("tokens"))
    # A generated row keeps the tokens from being split anew in every place that uses them.
    lines = lines.select("doc_id", "at", F.explode(F.array("tokens")).alias("tokens"))
    leaf = F.xxhash64(F.size("tokens"), F.slice("tokens", 1, parse.leading))
    return lines.select("doc_id", "at", leaf.alias("leaf"), "tokens")


def dropped_lines(docs: DataFrame, parse: Parse = Parse()) -> DataFrame:
    """(doc_id, at) of the lines of recurring templates, ``at`` from 0. Rows without doc_id count as one document."""
    stages = Stages(docs.sparkSession, "templates")
    lines = _lines(docs.select("doc_id", "text"), parse)
    docs_of = lines.groupBy("leaf", "doc_id").agg(F.count(F.lit(1)).alias("lines"))
    leaves = docs_of.groupBy("leaf").agg(F.count(F.lit(1)).alias("docs"), F.sum("lines").alias("lines"))
    leaves = stages.write(leaves.where(F.col("docs") >= parse.min_docs).select("leaf", "lines"), "leaves")
    shared = lines.join(maybe_broadcast(leaves, BROADCAST_LEAVES), "leaf")
    hashes = F.transform("tokens", lambda t: F.xxhash64(t))
    # Equal lines of a leaf are one from here on, so that frequent ones cost nothing.
    shared = stages.write(shared.select("doc_id", "at", "leaf", "lines", hashes.alias("tokens"), F.xxhash64("tokens").alias("form")), "shared")
    forms = stages.write(
        shared.groupBy("leaf", "form").agg(F.count(F.lit(1)).alias("n"), F.first("tokens").alias("tokens"), F.first("lines").alias("lines")), "forms"
    )
    fields = forms.select("leaf", "form", "lines", "n", F.posexplode("tokens").alias("place", "token"))
    counts = fields.groupBy("leaf", "place", "token").agg(F.sum("n").alias("seen"), F.first("lines").alias("lines"))
    constant = (F.col("seen") >= parse.min_docs) & (F.col("seen") >= F.col("lines") * parse.frequent)
    constants = counts.where(constant).select("leaf", "place", "token", F.lit(True).alias("constant"))
    marked = fields.join(constants, ["leaf", "place", "token"], "left")
    field = F.struct("place", F.when(F.col("constant"), F.col("token")).otherwise(F.lit(0).cast("long")).alias("token"))
    whole = marked.groupBy("leaf", "form").agg(F.array_sort(F.collect_list(field)).alias("fields"), F.count("constant").alias("fixed"), F.first("n").alias("n"))
    enough = F.col("fixed") >= F.size("fields") * parse.fixed
    template = F.when(enough, F.xxhash64("leaf", "fields")).otherwise(F.xxhash64("leaf", "form"))
    known = stages.write(whole.where(enough | (F.col("n") >= parse.min_docs)).select("leaf", "form", template.alias("template")), "known")
    with_template = stages.write(shared.join(known, ["leaf", "form"]).select("doc_id", "at", "template"), "lines")
    recurring = with_template.groupBy("template", "doc_id").agg(F.lit(1).alias("one")).groupBy("template").agg(F.count(F.lit(1)).alias("docs"))
    recurring = recurring.where(F.col("docs") >= parse.min_docs).select("template")
    return with_template.join(recurring, "template", "left_semi").select("doc_id", "at")


@adds("n_lines", "n_dropped", hidden=("_gone",))
def drop_template_lines(docs: DataFrame, parse: Parse = Parse()) -> DataFrame:
    """``docs`` with the lines of recurring templates taken out of text, and n_lines and n_dropped.

    ``docs`` needs doc_id long and text; its columns of the two new
    names give way. A template recurs if ``parse.min_docs`` documents have lines of it.
    Lines end at line feeds; lines without a token are never dropped; a null text
    stays null with 0 lines, an empty one has one line. Rows that repeat a doc_id are one document: a place
    dropped in one of them is dropped in all. Rows without doc_id keep their lines.
    """
    stages = Stages(docs.sparkSession, "template-lines")
    gone = dropped_lines(docs, parse).where("doc_id is not null")
    gone = stages.write(gone.groupBy("doc_id").agg(F.collect_set("at").alias("_gone")), "gone")
    found = docs.join(gone.hint("merge"), "doc_id", "left")  # by shuffle at any size
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda line, at: ~F.array_contains("_gone", at))
    touched = F.col("_gone").isNotNull()
    text = F.when(touched, F.array_join(kept, "\n")).otherwise(F.col("text"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines))
    n_dropped = F.when(touched & F.col("text").isNotNull(), F.size(lines) - F.size(kept)).otherwise(0)
    return found.select(
        *[text.alias(c) if c == "text" else F.col(c) for c in docs.columns],
        n_lines.cast("long").alias("n_lines"), n_dropped.cast("long").alias("n_dropped"),
    )
