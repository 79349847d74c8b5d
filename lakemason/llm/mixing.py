"""Mixing sources to target weights by weighted fair queueing.

Each source has a target: its share by weight of ``epochs`` times all words, at most ``most`` times its own words,
what is over going to the others by weight. The documents of a source queue in shuffled order (by a digest of
the id), again and again up to ``most`` times. A document's virtual finish time is the words of its source up
to its end divided by the source's target, so all sources reach their targets at time one. The arrivals of all
sources are sorted by finish time and truncated where their running total meets the total budget: a document
stays while no more than half of it lies beyond.

Running totals never gather a source in one task: rows are cut into many bins by digest (or by time), totals
of bins are carried forward, and only rows of one bin are windowed together.

Only DataFrame operations are used. A null text has size zero, a null source is a source of its own, and rows
equal in id, source and size queue as one unit and get the same result each. Empty documents take no words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemason.session import cut

#: Bins of a source (hex digits of the digest), and bins of one unit of virtual time.
DIGITS, TIME_BINS = 3, 4096


def words(text: Column | str) -> Column:
    """Number of runs of anything but ASCII space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), epochs: float = 1.5, most: int = 2) -> DataFrame:
    """``source, place, source_size, target`` from ``source, source_size``, one row a source.

    Sources take their weights in code-point order, null last. The target is ``min(most * size, weight * level)``
    with the one level at which targets sum to the budget; sources are tried in the order in which they would
    reach their limit. One task sees the list of sources, not their rows.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    listed = sizes.withColumn("place", F.row_number().over(by_name))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1)
    listed = listed.withColumn("weight", weight).withColumn("limit", F.col("source_size") * most)
    order = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) * epochs - before) / left
    levelled = listed.withColumn("level", level)
    free = F.when(F.col("level") < F.col("limit") / F.col("weight"), F.col("level"))
    levelled = levelled.withColumn("level", F.max(free).over(everything))
    target = F.coalesce(F.least(F.col("limit").cast("double"), F.col("weight") * F.col("level")), F.col("limit").cast("double"))
    return levelled.select("source", "place", "source_size", target.alias("target"))


def _carried(rows: DataFrame, keys: list[str], bin_: str, order: list[str], size: str) -> DataFrame:
    """``rows`` with ``done``: the running total of ``size`` over (bin, order) within ``keys``."""
    totals = rows.groupBy(*keys, bin_).agg(F.sum(size).alias("__bin"))
    ahead = F.coalesce(F.sum("__bin").over(Window.partitionBy(*keys).orderBy(bin_).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = totals.withColumn("__ahead", ahead).drop("__bin")
    local = F.sum(size).over(Window.partitionBy(*keys, bin_).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("done", local).join(totals, [*keys, bin_]).withColumn("done", F.col("done") + F.col("__ahead")).drop("__ahead")


def _time_bin(time: Column) -> Column:
    """Equal bins up to time two, then wider ones; later arrivals are never within the budget of large inputs."""
    return F.when(time < 2, F.floor(time * TIME_BINS)).otherwise(2 * TIME_BINS + F.floor((F.log2(time) - 1) * 256)).cast("bigint")


def mix(rows: DataFrame, weights: Sequence[float] = (3, 1, 2), epochs: float = 1.5, most: int = 2) -> DataFrame:
    """The mix of ``doc_id, source, size``: each distinct row with ``rows`` (how often it is there), ``source_size``,
    ``target``, ``copies`` (times the mix takes it, 0 to ``most``) and ``finish`` (virtual finish time, first copy)."""
    units = rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    units = cut(units.withColumn("digest", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))))
    units = units.withColumn("unit", F.col("size") * F.col("rows"))
    sources = cut(targets(units.groupBy("source").agg(F.sum("unit").alias("source_size")), weights, epochs, most))
    placed = units.join(sources, units["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    binned = placed.withColumn("bin", F.conv(F.substring("digest", 1, DIGITS), 16, 10).cast("int"))
    queued = cut(_carried(binned, ["place"], "bin", ["digest", "doc_id", "size"], "unit"))
    budget = sources.agg(F.sum("target")).first()[0] or 0.0

    def finish(copy: Column | int) -> Column:
        return F.coalesce((F.col("done") + F.lit(copy) * F.col("source_size")) / F.nullif("target", F.lit(0.0)), F.lit(0.0))

    def position(time: Column, copy: Column) -> Column:
        return F.struct(time.alias("time"), F.col("place").alias("place"), F.col("digest").alias("digest"), F.col("doc_id").alias("doc_id"), F.col("size").alias("size"), copy.alias("copy"))

    arrivals = queued.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(most - 1)))).withColumn("time", finish(F.col("copy")))
    arrivals = arrivals.withColumn("slot", _time_bin(F.col("time")))
    slots = arrivals.groupBy("slot").agg(F.sum("unit").alias("total"))
    slots = slots.withColumn("total", F.sum("total").over(Window.orderBy("slot")))
    full = slots.filter(F.col("total") > budget).agg(F.min("slot")).first()[0]
    if full is None:  # everything fits
        copies = F.lit(most)
    else:
        ahead = slots.filter(F.col("slot") < full).agg(F.max("total")).first()[0] or 0
        last = arrivals.filter(F.col("slot") == full)
        last = last.withColumn("until", F.sum("unit").over(Window.partitionBy("slot").orderBy(position(F.col("time"), F.col("copy")))) + ahead)
        edge = last.filter(F.col("until") - F.col("unit") / 2 <= budget).agg(F.max(position(F.col("time"), F.col("copy"))).alias("edge")).first().edge
        copies = F.lit(0)
        for copy in range(most):
            slot = _time_bin(finish(copy))
            inside = slot < full
            if edge is not None:
                fixed = F.struct(*[F.lit(value).cast(kind).alias(name) for name, value, kind in zip(
                    edge.__fields__, edge, ["double", "int", "string", dict(queued.dtypes)["doc_id"], "bigint", "int"])])
                inside = inside | ((slot == full) & (position(finish(copy), F.lit(copy)) <= fixed))
            copies = copies + F.when(inside, 1).otherwise(0)
    return queued.select("doc_id", "source", "size", "rows", "source_size", "target", copies.cast("int").alias("copies"), finish(0).alias("finish"))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The documents the mix takes, all their columns, a row a copy, in order of virtual finish time."""
    sized = docs.withColumn("__size", words(text))
    taken = mix(sized.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col("__size").alias("size")), **options)
    taken = taken.filter("copies > 0").select(F.struct("doc_id", "source", "size").alias("__key"), "copies", "finish", "source_size", "target").alias("taken")
    key = F.struct(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col("__size").alias("size"))
    both = sized.withColumn("__key", key).alias("docs").join(taken, F.col("docs.__key").eqNullSafe(F.col("taken.__key")))
    copy = F.explode(F.sequence(F.lit(0), F.col("taken.copies") - 1)).alias("__copy")
    time = (F.col("__finish") + F.col("__copy") * F.col("__source_size") / F.nullif("__target", F.lit(0.0))).alias("__time")
    rows = both.select("docs.*", F.col("taken.finish").alias("__finish"), F.col("taken.source_size").alias("__source_size"), F.col("taken.target").alias("__target"), copy)
    return rows.select("*", time).orderBy("__time", doc_id).select(*[F.col(f"`{c}`") for c in docs.columns])
