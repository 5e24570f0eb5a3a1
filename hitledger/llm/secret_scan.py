"""Secret scans: known forms, and sliding-window entropy of what else looks like a key.

Known forms are regular expressions. Beyond them, candidate strings are long
runs of key characters; a window slides over each and its Shannon entropy is
kept up to date by counts of the character that enters and the one that leaves.
A candidate whose best window reaches the threshold of its character class is a
secret unless the allow-list knows it.

All of it is DataFrame code on one row at a time: nothing is shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.llm.stages import adds, keeps

ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
# Runs of the character class are taken whole, so that a lower bound in the pattern drops short ones.
ACCESS, HEX = "AKIA[A-Z0-9]{12,}", "[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"

#: A word: one case, a capital first, or camel case of pieces with two small letters at least.
_WORD = "(?:[A-Z]*[a-z]+(?:[A-Z][a-z]{2,})*|[A-Z]+)"
#: Candidates that are no secrets however random they look.
ALLOWED = (
    r"^[^A-Za-z]*$",                                                               # numbers, dates
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUIDs
    rf"^[-_/+]*(?:{_WORD}|[0-9]+)(?:[-_/+]+(?:{_WORD}|[0-9]+))*[-_/+]*$",          # words and numbers between marks, paths
    r"(?i)(?:^|[^A-Za-z])(?:example|sample|dummy|placeholder|x{4,})(?:[^A-Za-z]|$)",  # documentation, as a part of its own
)
#: Fixed-point entropies, so that sums by increments and sums anew agree.
SCALE = 1 << 32


@dataclass(frozen=True)
class Entropy:
    """``window`` characters; least bits of a window of hex digits, and of mixed characters."""

    window: int = 20
    hex_bits: float = 3.0
    mixed_bits: float = 3.6

    @property
    def terms(self) -> list[int]:
        """c * log2(c) for counts c of 0 to ``window``."""
        return [0, *(round(c * math.log2(c) * SCALE) for c in range(1, self.window + 1))]

    def most(self, bits: float) -> int:
        """The largest sum of terms that a window of so many bits has."""
        return math.floor(self.window * (math.log2(self.window) - bits) * SCALE)


def _spans(text: Column, pattern: str, kind: int, least_group: int = 0) -> Column:
    """Leftmost non-overlapping matches as array of (start, kind, end), in code points, ends exclusive.

    What is between the matches tells where they are. With ``least_group``
    matches whose second group is shorter are left out.
    """
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if least_group else found
    parts = F.arrays_zip(F.slice(between, F.lit(1), F.size(found)).alias("gap"), found.alias("hit"), checked.alias("group"))
    empty = F.lit(None).cast("array<struct<start:int,kind:int,end:int>>")

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["gap"])
        end = start + F.length(part["hit"])
        own = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
        keep = F.length(part["group"]) >= least_group
        return F.struct(end.alias("at"), F.when(keep, F.concat(state["out"], own)).otherwise(state["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.coalesce(empty, F.array().cast("array<struct<start:int,kind:int,end:int>>")).alias("out"))
    spans = F.aggregate(parts, start, step)["out"]
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>"))


def best_window(candidate: Column, entropy: Entropy) -> Column:
    """The smallest sum of c * log2(c) over all windows of a candidate: that of its window of highest entropy.

    One step for each character: its count goes up, that of the character that
    leaves the window goes down, and the sum changes by these two terms only.
    """
    terms = F.array(*[F.lit(t).cast("long") for t in entropy.terms])
    place = lambda at: F.instr(F.lit(ALPHABET), F.substring(candidate, at, F.lit(1)))
    term = lambda count: F.get(terms, count)

    def step(state: Column, at: Column) -> Column:
        old = F.when(at > entropy.window, place(at - entropy.window)).otherwise(F.lit(0))
        ends = F.array(F.struct(place(at).alias("new"), old.alias("old")))

        def moved(end: Column) -> Column:
            counts = state["counts"]
            grown, shrunk = F.get(counts, end["new"] - 1), F.get(counts, end["old"] - 1)
            change = F.when(end["new"] == end["old"], F.lit(0).cast("long")).otherwise(
                term(grown + 1) - term(grown) + F.when(end["old"] > 0, term(shrunk - 1) - term(shrunk)).otherwise(F.lit(0).cast("long"))
            )
            after = F.transform(counts, lambda c, k: c + F.when(k == end["new"] - 1, 1).otherwise(0) - F.when(k == end["old"] - 1, 1).otherwise(0))
            return F.struct(after.alias("counts"), (state["sum"] + change).alias("sum"))

        def rated(next_: Column) -> Column:
            best = F.when(at >= entropy.window, F.least(state["best"], next_["sum"])).otherwise(state["best"])
            return F.struct(next_["counts"].alias("counts"), next_["sum"].alias("sum"), best.alias("best"))

        return F.get(F.transform(F.transform(ends, moved), rated), F.lit(0))

    zero = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0).cast("long").alias("sum"), F.lit(2**62).cast("long").alias("best")
    )
    return F.aggregate(F.sequence(F.lit(1), F.length(candidate)), zero, step)["best"]


def entropy_spans(text: Column, entropy: Entropy) -> Column:
    """Candidates with a window of high entropy as array of (start, kind, end)."""
    pattern = f"[A-Za-z0-9+/_-]{{{entropy.window},}}"
    inside = lambda s: F.substring(text, s["start"] + 1, s["end"] - s["start"])

    def secret(span: Column) -> Column:
        candidate = inside(span)
        allowed = F.lit(False)
        for known in ALLOWED:
            allowed = allowed | candidate.rlike(known)
        is_hex = candidate.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")
        most = F.when(is_hex, F.lit(entropy.most(entropy.hex_bits))).otherwise(F.lit(entropy.most(entropy.mixed_bits)))
        # Conditions are asked one after the other, so that windows slide over what is left only.
        return F.when(allowed, F.lit(False)).otherwise(best_window(candidate, entropy) <= most)

    return F.filter(_spans(text, pattern, KINDS.index("entropy")), secret)


@adds("base_spans", "spans", hidden=("_more",))
def secret_spans(docs: DataFrame, entropy: Entropy = Entropy()) -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``: arrays of (start, kind, end), kind a place in ``KINDS``.

    ``docs`` needs text; its columns of these names give way. Spans count
    code points, ends exclusive, and are in order of start, then kind.
    ``base_spans`` are the known forms, of each kind the leftmost ones that do
    not overlap; ``spans`` has those and the entropy spans that overlap none of
    them. A null text is empty; empty texts have no spans; texts of any length
    are scanned whole; repeated rows and other columns stay as they are.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = F.concat(_spans(text, ASSIGN, 0, 8), _spans(text, ACCESS, 1), _spans(text, HEX, 2))
    found = docs.withColumns({"base_spans": F.array_sort(base), "_more": entropy_spans(text, entropy)})
    apart = F.filter("_more", lambda m: ~F.exists("base_spans", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    return found.withColumn("spans", F.array_sort(F.concat("base_spans", apart))).drop("_more")


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


@keeps("base_spans", "spans")
def redact(docs: DataFrame, entropy: Entropy = Entropy(), mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret's characters replaced by ``mark``; overlapping spans become one."""
    found = secret_spans(docs, entropy)
    text = F.coalesce(F.col("text"), F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["at"]
        gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        out = F.when(fresh, F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out"))

    done = F.aggregate("spans", start, step)
    whole = F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
    new = F.when(F.size("spans") > 0, whole).otherwise(F.col("text")).alias("text")
    return found.select([new if name == "text" else F.col(name) for name in docs.columns])
