"""Mixing sources to target weights by entropy balancing, with DataFrame operations only.

A document's rate is how often the mix takes it. Among all rates that meet the word targets, those are
chosen that change the corpus least: the sum over words of r ln r - r is smallest. The solution
tilts every document exponentially, r = exp(sum of the multipliers of its cells), at most ``most``;
the multipliers solve the convex dual, which Newton iterations do margin by margin. An iteration is
one aggregate over the cells (documents of equal margins, summed first, so a hot source is one row).

Rates become whole copies. Documents of a source go by size, largest first, and every 1/f-th of them gets
one copy more than the rest (f: the fraction of the rate); as neighbours have nearly one size, what one
has too much the next has too little. What is still missing from a source's target is made up from a
few candidates, one of each half octave of size, the largest that fits first.

Defined results: a null text has no words; a source without words has target 0 and nothing is taken;
a null source is a source and comes last; equal sizes go by id, a null id first; repeated rows count
as often as they come. Other columns are not looked at. Reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotegrid.llm.common import WORD, packed
from quotegrid.session import materialize

CELL = 1 << 16  # documents ranked in one group
PHASE = 0.4142135623  # where counting starts; no whole count falls on a step


def word_count(text: Column) -> Column:
    """Words of a text: each is replaced by one letter, the rest goes."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "x")
    return F.length(F.translate(marks, " \t\n\x0b\x0c\r", "")).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``source``, ``source_size``, ``target``: all words shared by weight, at most ``most`` times the source.

    Weights are dealt in the order of the source names and repeat. What a source cannot take is shared among the others
    by weight until none is above its most; each round is one aggregate of two sums over a row per source.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (turn % len(weights) + 1).cast("int"))
    state = materialize(sums.select("source", "source_size", w.cast("long").alias("w")), "sources")
    total = state.agg(F.sum("source_size")).first()[0] or 0
    full = F.lit(False)  # sources that stop at their most
    while True:
        taken, free = state.agg(
            F.sum(F.when(full, most * F.col("source_size")).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("w")))
        ).first()
        share = F.col("w") * F.lit(total - (taken or 0)).cast("double") / F.lit(free or 1).cast("double")
        target = F.when(full, most * F.col("source_size")).otherwise(share)
        above = (share > most * F.col("source_size")) & ~full
        if not state.where(above).limit(1).count():
            return state.select("source", "source_size", target.cast("double").alias("target"))
        # all sources up to the largest ratio that is above stop together
        level = state.where(above).agg(F.max(F.col("source_size") / F.col("w"))).first()[0]
        full = F.col("source_size") / F.col("w") <= level


def balance(cells: DataFrame, margins: dict[str, DataFrame], most: float = 3.0, steps: int = 50, close: float = 1e-12):
    """Rates of the cells. ``cells`` has the margins' columns and ``size``; a margin has its column and ``target``.

    Newton steps on one margin after the other until each sum is as near to its target as ``close`` of it.
    """
    cells = cells.withColumn("tilt", F.lit(0.0))
    cap = float(most)
    for _ in range(steps):
        off = 0.0
        for name, targets in margins.items():
            rate = F.least(F.exp("tilt"), F.lit(cap))
            sums = cells.groupBy(name).agg(
                F.sum(F.col("size") * rate).alias("now"),
                F.sum(F.when(F.exp("tilt") < cap, F.col("size") * rate).otherwise(0.0)).alias("free"),
            )
            goal = targets.select(F.col(name).alias("_of"), "target")
            step = sums.join(goal, sums[name].eqNullSafe(F.col("_of"))).select(
                "_of",
                # nothing to take: the multiplier that leaves less than a word of any corpus
                F.when(F.col("target") <= 0, -100.0)
                # upwards only those below the cap still move, downwards all
                .when(F.col("now") > F.col("target"), F.col("target") / F.col("now") - 1)
                .when(F.col("free") > 0, F.least((F.col("target") - F.col("now")) / F.col("free"), F.lit(math.log(cap))))
                .otherwise(0.0)
                .alias("step"),
                F.when(F.col("target") > 0, F.abs(F.col("now") / F.col("target") - 1)).otherwise(0.0).alias("off"),
            )
            step = materialize(step, "newton")
            worst = step.agg(F.max("off")).first()[0] or 0.0
            off = max(off, worst)
            if worst > close:
                cells = cells.join(step.drop("off"), cells[name].eqNullSafe(F.col("_of")), "left")
                tilt = F.col("tilt") + F.coalesce("step", F.lit(0.0))
                cells = materialize(cells.withColumn("tilt", tilt).drop("_of", "step"), "newton")
        if off <= close:
            break
    return cells.withColumn("rate", F.round(F.least(F.exp("tilt"), F.lit(cap)), 9)).drop("tilt")


def _half_octave(size: Column) -> Column:
    bits = F.bin(size)
    return F.length(bits) * 2 + F.when(F.substring(bits, 2, 1) == "1", 1).otherwise(0)


def copies_of(sized: DataFrame, rates: DataFrame, most: int = 3) -> DataFrame:
    """``sized`` (doc_id, source, size) with ``source_size``, ``target`` and ``copies``. ``rates``: a row per source."""
    order = F.coalesce("doc_id", F.lit(-(1 << 63)))
    rates = rates.withColumnRenamed("source", "_source")
    alike = F.col("source").eqNullSafe(F.col("_source"))
    # documents of one source and size in cells of bounded size, and how many come before each cell
    many = sized.groupBy("source", "size").agg(F.count("*").alias("n"))
    many = many.select(F.col("source").alias("_s"), F.col("size").alias("_z"), F.ceil(F.col("n") / CELL).alias("parts"))
    parted = sized.join(many, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")))
    parted = parted.withColumn("part", F.pmod(order, F.col("parts"))).drop("_s", "_z", "parts")
    cells = parted.groupBy("source", "size", "part").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("source").orderBy(F.desc("size"), "part").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        F.col("source").alias("_s"),
        F.col("size").alias("_z"),
        F.col("part").alias("_p"),
        F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"),
    )
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")) & (F.col("part") == F.col("_p"))
    own = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy(order))
    ranked = parted.withColumn("own", own).join(cells, same).withColumn("k", F.col("before") + F.col("own"))
    rated = ranked.join(rates, alike)
    whole = F.floor("rate")
    step = lambda k: F.floor((F.col("rate") - whole) * k + F.lit(PHASE))
    copies = F.least(whole + step(F.col("k")) - step(F.col("k") - 1), F.lit(most))
    first = rated.select("doc_id", "source", "size", "source_size", "target", copies.cast("long").alias("copies"))
    first = materialize(first, "copies")

    # what is missing is made up from one document of each half octave
    short = first.groupBy("source").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("short"))
    short = short.withColumnRenamed("source", "_source")
    open_ = first.where("size > 0").join(short, alike)
    open_ = open_.where(F.when(F.col("short") > 0, F.col("copies") < most).otherwise(F.col("copies") > 0))
    chosen = open_.groupBy("source", "short", _half_octave(F.col("size")).alias("octave")).agg(
        F.min(F.struct(order.alias("o"), "doc_id", "size")).alias("c")
    )
    listed = chosen.groupBy("source", "short").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("c.size")).alias("z"), F.col("c.doc_id").alias("id")))).alias("cs")
    )
    fit = lambda acc, c: F.struct(
        F.when(-c["z"] <= acc["left"], acc["left"] + c["z"]).otherwise(acc["left"]).alias("left"),
        F.when(-c["z"] <= acc["left"], F.concat(acc["ids"], F.array(c["id"]))).otherwise(acc["ids"]).alias("ids"),
    )
    nothing = F.struct(F.abs("short").alias("left"), F.expr("cast(array() as array<bigint>)").alias("ids"))
    picked = listed.select(
        F.col("source").alias("_source"),
        F.when(F.col("short") > 0, 1).otherwise(-1).alias("more"),
        F.explode(F.aggregate("cs", nothing, fit)["ids"]).alias("_id"),
    )
    mended = first.join(picked, alike & F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("size") > 0), "left")
    return mended.withColumn("copies", F.col("copies") + F.coalesce("more", F.lit(0))).drop("_source", "_id", "more")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken of every row of ``docs``."""
    sized = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    targets = source_targets(sized, weights, most)
    cells = sized.groupBy("source").agg(F.sum("size").cast("double").alias("size"))
    rates = balance(cells, {"source": targets}, most).drop("size")
    rates = rates.withColumnRenamed("source", "_of")
    rates = targets.join(rates, targets["source"].eqNullSafe(F.col("_of"))).drop("_of")
    found = copies_of(sized, rates, most)
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return found.select("doc_id", "size", "source_size", "target", "copies", taken)


def take(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, in the columns of ``docs``.

    Rows that share an id share the copies of all of them.
    """
    per = mix(docs, weights, most).groupBy("doc_id").agg(F.sum("copies").cast("int").alias("copies"), F.count("*").alias("n"))
    per = per.where("copies > 0").withColumnRenamed("doc_id", "id")
    rows, unpack = packed(docs, "doc_id")
    met = rows.join(per, F.col("doc_id").eqNullSafe(F.col("id")))
    # rows of one id are equally often taken, as far as their number goes into the copies
    again = met.where("n > 1")
    turn = F.row_number().over(Window.partitionBy("doc_id").orderBy("rest"))
    again = again.withColumn("copies", (F.floor(F.col("copies") / F.col("n")) + F.when(turn <= F.col("copies") % F.col("n"), 1).otherwise(0)).cast("int"))
    both = met.where("n = 1").unionByName(again.where("copies > 0"))
    return unpack(both.select("doc_id", "rest", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")))
