"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source starts with the same expected number of copies. The
whole part is certain; the fractional part is rounded dependently: two documents
meet, a random one takes words of expectation from the other until one of the
two is whole, and the other goes on. Expected words are kept exactly by every
meeting, so a source misses its target by one document at most.

Documents meet in blocks of about ``FAN_IN``; what a block leaves over meets
again in the next level, so a source of n documents takes log(n) levels and no
task sees more than a block. A source's few large documents go first, and what
their last one misses is spread over the smaller ones' expectations.

All of it is DataFrame code; what is random is a hash of the documents that meet.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitledger.llm.stages import Stages, maybe_broadcast

FAN_IN = 64
#: A document is large with more than one HUGE-th of its source's words, else middling with more than one LARGE-th.
HUGE, LARGE = 16, 256
#: Sources up to this number may be broadcast.
BROADCAST_SOURCES = 100_000
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """``weights`` go to the sources in order, over and over; ``share`` of all words is wanted, at most ``most`` times each document."""

    weights: tuple[float, ...] = (3, 1, 2)
    share: float = 1.5
    most: int = 2
    seed: int = 17


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, mix: Mix) -> DataFrame:
    """``sources`` (source, source_size long), one row each, with ``target`` double.

    A source stops at ``most`` times its size, and what it cannot take goes to
    the others by weight: with the sources in order of limit / weight, a first
    part of them is full and the others share what is left. Windows here see one
    row for each source.
    """
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    limit = F.col("source_size").cast("double") * mix.most
    rows = sources.withColumn("weight", F.get(weights, F.pmod(order, F.lit(len(mix.weights))))).withColumn("limit", limit)
    everyone = Window.partitionBy()
    fullest = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fullest.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "*",
        (F.sum("source_size").over(everyone) * F.lit(mix.share) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))).alias("left"),
        (F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("open"),
    )
    # The first source that is not full sets the level for itself and all after it.
    rows = rows.withColumn("level", F.when(F.col("limit") * F.col("open") >= F.col("left") * F.col("weight"), F.struct("left", "open")))
    level = F.first("level", ignorenulls=True).over(fullest.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("level", level)
    target = F.when(F.col("level").isNull(), F.col("limit")).otherwise(F.col("level.left") / F.col("level.open") * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def _uniform(*parts: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(2**53))


def _random_sql(seed: int, a: str, b: str) -> str:
    return f"shiftrightunsigned(xxhash64({seed}L, {a}.doc_id, {a}.size, {b}.doc_id, {b}.size), 11) / {float(2**53)!r}D"


UNIT = "struct<doc_id: bigint, size: bigint, rows: bigint, base: int, m: double, x: double>"
DONE = "array<struct<u: " + UNIT + ", up: boolean>>"


def _rounded(units: str, seed: int) -> Column:
    """Pivotal rounding of an array of units, one after the other: struct (rest, done).

    A unit has mass m and expected mass x, 0 < x < m, above its base copies;
    done units are up (x = m) or not (x = 0), and at most one is left in rest.
    """
    plus = f"{_random_sql(seed, 's.rest', 'u')} < least(s.rest.x, u.m - u.x) / (least(s.rest.m - s.rest.x, u.x) + least(s.rest.x, u.m - u.x))"
    moved = "if(p, least(s.rest.m - s.rest.x, u.x), -least(s.rest.x, u.m - u.x))"
    first_done = "if(p, s.rest.m - s.rest.x <= u.x, s.rest.x <= u.m - u.x)"
    second_done = "if(p, u.x <= s.rest.m - s.rest.x, u.m - u.x <= s.rest.x)"
    kept = lambda u, x: f"named_struct('doc_id', {u}.doc_id, 'size', {u}.size, 'rows', {u}.rows, 'base', {u}.base, 'm', {u}.m, 'x', {x})"
    meeting = f"""element_at(transform(array({plus}), p -> named_struct(
        'rest', case when {first_done} and {second_done} then cast(null as {UNIT})
                     when {first_done} then {kept('u', f'u.x - {moved}')} else {kept('s.rest', f's.rest.x + {moved}')} end,
        'done', concat(s.done, if({first_done}, array(named_struct('u', s.rest, 'up', p)), cast(array() as {DONE})),
                               if({second_done}, array(named_struct('u', u, 'up', not p)), cast(array() as {DONE}))))), 1)"""
    start = f"named_struct('rest', cast(null as {UNIT}), 'done', cast(array() as {DONE}))"
    return F.expr(f"aggregate({units}, {start}, (s, u) -> if(s.rest is null, named_struct('rest', u, 'done', s.done), {meeting}))")


def _units(rows: DataFrame, ratio: Column, mix: Mix) -> DataFrame:
    """``rows`` with a unit each: base copies and the expected words above them."""
    ratio = F.least(F.greatest(ratio, F.lit(0.0)), F.lit(float(mix.most)))
    base = F.floor(ratio).cast("int")
    mass = (F.col("size") * F.col("rows")).cast("double")
    unit = F.struct("doc_id", "size", "rows", base.alias("base"), mass.alias("m"), (mass * (ratio - base)).alias("x"))
    return rows.withColumn("unit", unit.cast(UNIT))


def _split(unit: str) -> Column:
    """Whether a unit is whole by now, so that it meets nobody."""
    return (F.col(f"{unit}.x") <= 0) | (F.col(f"{unit}.x") >= F.col(f"{unit}.m"))


def _large_ones(units: DataFrame, mix: Mix) -> DataFrame:
    """Huge and large documents of each source, at most HUGE + LARGE of them: (source, done, ratio of the small ones)."""
    first, then = "filter(units, u -> u.m * {0} > source_size)".format(HUGE), "filter(units, u -> u.m * {0} <= source_size)".format(HUGE)
    rows = units.groupBy("source", "source_size", "target").agg(
        F.reverse(F.array_sort(F.collect_list(F.struct(F.col("unit.m").alias("m"), F.col("unit.doc_id").alias("id"), F.col("unit.size").alias("s"), "unit")))).alias("all")
    )
    rows = rows.withColumn("units", F.expr("transform(all, v -> v.unit)")).drop("all")
    rows = rows.withColumn("ratio", F.col("target") / F.col("source_size")).withColumn("done", F.expr(f"cast(array() as {DONE})"))
    rows = rows.withColumn("mass", F.col("source_size").cast("double"))
    for step, own in enumerate((first, then)):
        rows = rows.withColumn("own", F.expr(own))
        # Expected copies anew from what is left to take.
        rows = rows.withColumn("base", F.floor("ratio").cast("int"))
        rows = rows.withColumn("own", F.expr(
            "transform(own, u -> named_struct('doc_id', u.doc_id, 'size', u.size, 'rows', u.rows, 'base', base, 'm', u.m, 'x', u.m * (ratio - base)))"
        ))
        whole = f"if(ratio = base, named_struct('rest', cast(null as {UNIT}), 'done', transform(own, u -> named_struct('u', u, 'up', false))), r)"
        rows = rows.withColumn("r", _rounded("own", mix.seed + step)).withColumn("r", F.expr(whole))
        coin = f"({_random_sql(mix.seed + 100 + step, 'r.rest', 'r.rest')} < r.rest.x / r.rest.m)"
        last = f"if(r.rest is null, cast(array() as {DONE}), array(named_struct('u', r.rest, 'up', {coin})))"
        rows = rows.withColumn("fresh", F.concat("r.done", F.expr(last)))
        taken = F.expr("aggregate(fresh, 0D, (t, d) -> t + d.u.m * (d.u.base + if(d.up, 1, 0)))")
        held = F.expr("aggregate(own, 0D, (t, u) -> t + u.m)")
        rows = rows.withColumns({"taken": taken, "held": held, "done": F.concat("done", "fresh")})
        rows = rows.withColumns({"left": F.col("ratio") * F.col("mass") - F.col("taken"), "mass": F.col("mass") - F.col("held")})
        ratio = F.when(F.col("mass") >= 1, F.col("left") / F.col("mass")).otherwise(F.lit(0.0))
        rows = rows.withColumn("ratio", F.least(F.greatest(ratio, F.lit(0.0)), F.lit(float(mix.most))))
    return rows.select("source", F.col("ratio").alias("small_ratio"), "done")


def copies(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """How often the mix takes each document of ``docs`` (doc_id long, text, source string).

    One row for each row: doc_id, source, size (its words), source_size, target
    (of its source, in words), copies int and taken (copies * size) long. Rows
    that share doc_id, source and size are taken equally often. A text that is
    null or empty has size 0 and the certain copies of its source. A null source
    is a source, the last one; an empty table gives an empty result. Other
    columns of ``docs`` are ignored. The same documents give the same mix.
    """
    stages = Stages(docs.sparkSession, "mix")
    counted = docs.select("doc_id", "source", word_count("text").alias("size"))
    rows = stages.write(counted.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows")), "sizes")
    totals = rows.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    sources = targets(totals, mix).alias("t").join(totals.alias("n"), F.expr("t.source <=> n.source")).select("t.*", "n.n_docs")
    sources = stages.write(sources, "sources")
    near = maybe_broadcast(sources.withColumnRenamed("source", "own"), BROADCAST_SOURCES)
    units = rows.join(near, F.col("source").eqNullSafe(F.col("own"))).drop("own")
    large = F.col("size") * F.col("rows") * LARGE > F.col("source_size")
    some = F.col("size") > 0
    big = stages.write(_large_ones(_units(units.where(some & large), F.lit(0.0), mix), mix), "large")
    ratios = maybe_broadcast(big.select(F.col("source").alias("own"), "small_ratio"), BROADCAST_SOURCES)
    rest = units.where(~(some & large)).join(ratios, F.col("source").eqNullSafe(F.col("own")), "left").drop("own")
    usual = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    small = _units(rest, F.coalesce("small_ratio", usual), mix).select("source", F.col("n_docs").alias("n"), "unit")
    small = stages.write(small, "small")

    done = [
        big.select("source", F.explode("done").alias("d")).select("source", "d.u", "d.up"),
        small.where(_split("unit")).select("source", F.col("unit").alias("u"), (F.col("unit.x") > 0).alias("up")),
    ]
    pool = small.where(~_split("unit"))
    most = sources.agg(F.max("n_docs")).first()[0] or 0
    level = 0
    while most > 0:
        level += 1
        most = 0 if most == 1 else -(-most // FAN_IN)
        blocks = F.ceil(F.col("n") / FAN_IN)
        block = F.pmod(F.xxhash64(F.lit(mix.seed + level), "unit.doc_id", "unit.size"), blocks)
        order = F.struct(F.col("unit.m").alias("m"), F.xxhash64(F.lit(mix.seed - level), "unit.doc_id", "unit.size").alias("o"), "unit")
        met = pool.groupBy("source", blocks.alias("n"), block.alias("block")).agg(F.reverse(F.array_sort(F.collect_list(order))).alias("all"))
        met = met.withColumn("units", F.expr("transform(all, v -> v.unit)")).withColumn("r", _rounded("units", mix.seed + level))
        met = stages.write(met.select("source", "n", "r.rest", "r.done"), "level")
        done.append(met.select("source", F.explode("done").alias("d")).select("source", "d.u", "d.up"))
        pool = met.where("rest is not null").select("source", "n", F.col("rest").alias("unit"))
    coin = _uniform(F.lit(mix.seed + 200), F.col("unit.doc_id"), F.col("unit.size")) < F.col("unit.x") / F.col("unit.m")
    done.append(pool.select("source", F.col("unit").alias("u"), coin.alias("up")))

    all_done = done[0]
    for more in done[1:]:
        all_done = all_done.union(more)
    n_copies = F.col("u.base") + F.when(F.col("up"), F.lit(1)).otherwise(F.lit(0))
    out = all_done.select("source", "u.doc_id", "u.size", n_copies.alias("copies"), F.explode(F.sequence(F.lit(1), F.col("u.rows").cast("int"))).alias("row"))
    sizes = maybe_broadcast(sources.select(F.col("source").alias("own"), "source_size", "target"), BROADCAST_SOURCES)
    return out.join(sizes, F.col("source").eqNullSafe(F.col("own"))).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken")
    )


def mix_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``docs`` with each row as often as the mix takes it (0 to ``most`` times); columns as they were."""
    stages = Stages(docs.sparkSession, "mixed")
    taken = copies(docs, mix).where("copies > 0").select("doc_id", "source", "size", "copies").distinct()
    # By shuffle at any size: a list of most documents is none to broadcast.
    taken = stages.write(taken, "copies").hint("merge").alias("t")
    own = docs.select(F.struct("*").alias("row"), "doc_id", "source", word_count("text").alias("size")).alias("d")
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"t.{c}")) for c in ("doc_id", "source", "size")]
    both = own.join(taken, same).select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return both.select("row.*")
