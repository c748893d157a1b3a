"""Mixing sources to target weights by capped water-filling.

Each source gets words in proportion to its weight, but at most `most_epochs`
times what it has; what a full source can't take is shared out again among the
others by weight until all fit. With sources in order of cap / weight this is
one level for all that aren't full, found from running sums over the sources.

A source's target over its size gives its epochs: a whole number of
repetitions of every document, and a fraction. For the fraction, documents
stand in a seeded random order, and those before the point where the fraction
of the source's words is reached are taken once more; the document at that
point is taken if its middle lies before it. So a source misses its target by
at most half a document.

Running sums go over slices of the random order. Their number grows with the
documents, so a source with most of the rows is many slices, each summed on
its own; only the slice that holds the point is looked at row by row. The
documents themselves never move: each compares its place with its source's
point.

Defined cases: a null or empty text has size 0 and takes 0; a null source is a
source of its own, last in order; rows of one doc_id with different texts have
places of their own, and so do rows without doc_id; rows equal in both are taken
alike, so a source misses its target by half of what such a group holds; a very
long text is one document; an empty table gives an empty mix; a source without
words takes nothing; other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage
from .native import word_count
from .tables import fresh

SEED = 17
WEIGHTS = (5, 2, 1)
#: Documents of one slice of the random order.
PER_SLICE = 20_000
#: Sources whose plan may travel to every task; more are joined by a shuffle.
SENT_SOURCES = 100_000
#: Places in the random order: 15 hex digits.
PLACES = 1 << 60


def ranked_weights(weights=WEIGHTS) -> Column:
    """Sources by code point, null last, weigh `weights` in turn."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))


def targets(sizes: DataFrame, weight: Column, share: float, most_epochs: float) -> DataFrame:
    """source, source_size and target, from source and source_size: one row a
    source. `share` is the mix's size as a multiple of all sizes."""
    known = sizes.withColumn("weight", weight.cast("double")).withColumn(
        "cap", F.col("source_size") * F.lit(float(most_epochs)))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    everything = by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    levelled = known.withColumn("level", (total - before) / rest)
    # The first source that its level doesn't fill sets the level of all after it.
    opened = F.when(F.col("level") < F.col("cap") / F.col("weight"), F.col("level"))
    levelled = levelled.withColumn("open", F.first(opened, ignorenulls=True).over(everything))
    target = F.coalesce(F.least(F.col("cap"), F.col("weight") * F.col("open")), F.col("cap"))
    return levelled.select("source", "source_size", target.alias("target"))


def _place(id: str, text: str, seed: int) -> Column:
    name = F.concat_ws(" ", F.lit(str(seed)), F.coalesce(F.col(id).cast("string"), F.lit("text")), F.coalesce(F.col(text), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("bigint")


def _plan(docs, id, text, source, weight, share, most_epochs, seed):
    """One row a source: its size, target, whole repetitions and the point up
    to which documents are taken once more."""
    slices = max(1, -(-docs.count() // PER_SLICE))
    width = -(-PLACES // slices)
    rows = docs.select(F.col(source).alias("source"), F.col(text).alias("text"), _place(id, text, seed).alias("place"))
    rows = rows.withColumn("slice", F.floor(F.col("place") / F.lit(width)))
    sums = cut_lineage(rows.groupBy("source", "slice").agg(F.sum(word_count(F.col("text"))).alias("words")))

    sizes = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = targets(sizes, weight if weight is not None else ranked_weights(), share, most_epochs)
    plan = plan.withColumn("whole", F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0).cast("bigint")))
    plan = cut_lineage(plan.withColumn("more", F.col("target") - F.col("whole") * F.col("source_size")))

    up_to = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    running = sums.withColumn("before", F.coalesce(F.sum("words").over(up_to), F.lit(0)))
    held = running.join(F.broadcast(plan) if _few(plan) else plan, running["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    held = cut_lineage(held.where((F.col("before") <= F.col("more")) & (F.col("more") < F.col("before") + F.col("words")))
                       .select("source", F.col("slice").alias("cut_slice"), "before", "more"))

    few = F.broadcast(held) if _few(plan) else held
    inside = rows.join(few, rows["source"].eqNullSafe(held["source"]) & (rows["slice"] == held["cut_slice"])).drop(held["source"])
    places = inside.groupBy("source", "place").agg(
        F.sum(word_count(F.col("text"))).alias("words"), F.first("before").alias("before"), F.first("more").alias("more"))
    step = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("before") + F.coalesce(F.sum("words").over(step), F.lit(0)) + F.col("words") / 2
    cuts = places.withColumn("late", middle > F.col("more")).groupBy("source").agg(
        F.min(F.when(F.col("late"), F.col("place"))).alias("cut"), F.max("place").alias("last"))
    cuts = cuts.select(F.col("source").alias("cut_source"), F.coalesce("cut", F.col("last") + 1).alias("cut"))
    whole = plan.join(cuts, plan["source"].eqNullSafe(cuts["cut_source"]), "left")
    cut = F.when(F.col("more") > 0, F.col("cut"))
    return cut_lineage(whole.select("source", "source_size", "target", "whole", F.coalesce(cut, F.lit(0)).alias("cut")))


def _few(plan: DataFrame) -> bool:
    return plan.limit(SENT_SOURCES + 1).count() <= SENT_SOURCES


def mix(docs: DataFrame, out: str, id: str = "doc_id", text: str = "text", source: str = "source",
        weight: Column | None = None, share: float = 1.5, most_epochs: float = 2.0, seed: int = SEED) -> DataFrame:
    """`docs` with a struct column `out`: size (words), source_size and target
    of its source, repeats (how often it is taken) and taken (its words times
    that). `weight` is a column over the sources; by default they weigh by
    rank."""
    plan = _plan(docs, id, text, source, weight, share, most_epochs, seed)
    mine = plan.select(F.struct(*plan.columns).alias("plan"))
    rows = docs.withColumn(out, F.struct(word_count(F.col(text)).alias("size"), _place(id, text, seed).alias("place")))
    key = fresh(docs, "plan")
    mine = mine.withColumnRenamed("plan", key)
    rows = rows.join(F.broadcast(mine) if _few(plan) else mine, rows[source].eqNullSafe(mine[key]["source"]), "left")
    repeats = F.col(key)["whole"] + F.when(F.col(out)["place"] < F.col(key)["cut"], 1).otherwise(0)
    return rows.withColumn(out, F.struct(
        F.col(out)["size"].alias("size"), F.col(key)["source_size"].alias("source_size"),
        F.col(key)["target"].alias("target"), repeats.alias("repeats"),
        (F.col(out)["size"] * repeats).alias("taken"))).drop(key)


def mixing_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    rows = mix(docs.select("doc_id", "text", "source"), "mix")
    return rows.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")

