"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources share a budget of words by weight; none takes more than ``most`` times
its own size, and what it leaves is shared again among the others.  A source
takes its complete epochs first, then a weighted sample without replacement up
to its budget: each document draws an exponential key, scaled by its quality
weight, and documents come in order of their keys until the budget is reached.

The order is never sorted as a whole.  Keys fall into bins of equal probability;
sums by source and bin tell which bin a source's budget ends in, and only that
bin's documents are put in order.  Bins are as many as the corpus needs for a
few thousand documents each, so a hot source is no one task's work.

Null texts have size 0; null sources form a source of their own, last in order.
Rows with equal keys (repeated rows) follow by doc_id, size and text hash.
Sources without words have target 0.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwright.llm import workspace

#: Documents of a bin, about.
BIN_ROWS = 4096
WEIGHTS = (3, 1, 2)


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """sizes (source, source_size), one row per source, with its target.

    Sources by code point, null last, take the weights in turn.  With sources in
    order of most * size / weight, the level at which the budget is met follows
    from prefix sums: those before it are full, the others get weight * level.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    ranked = sizes.withColumn("weight", F.element_at(cycle, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    full = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    after = full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    capped = ranked.withColumn("cap", (F.lit(most) * F.col("source_size")).cast("double"))
    level = (F.lit(share) * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    met = capped.withColumn("_level", level).withColumn("_level", F.when(F.col("_level") * F.col("weight") <= F.col("cap"), F.col("_level")))
    return met.withColumn("_level", F.max("_level").over(every)).select(
        "source", "source_size", F.when(F.col("_level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("_level") * F.col("weight"))).alias("target")
    )


def uniform(*of: Column, seed: int = 0) -> Column:
    """A number in (0, 1) from the columns' MD5, the same in any engine."""
    text = F.concat_ws("/", F.lit(str(seed)), *(F.coalesce(c.cast("string"), F.lit("-")) for c in of))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def mix(docs: DataFrame, quality: DataFrame | None = None, split: bool = True, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    ``quality`` has weights (doc_id, weight > 0); documents without one weigh 1.
    With ``split`` the document in which a budget ends gives only the words that
    are left; without, it is taken whole if that comes nearer to the budget.
    """
    with workspace.Scratch(docs.sparkSession) as scratch:
        own = docs.select("doc_id", "source", words(F.col("text")).alias("size"), F.xxhash64("text").alias("_hash"))
        rows = scratch.table(own, "sizes")
        sources = scratch.table(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows")), "sources")
        budget = scratch.table(targets(sources.select("source", "source_size")).join(sources.select(F.col("source").alias("_s"), "_rows"), F.col("source").eqNullSafe(F.col("_s"))).select(
            F.col("source").alias("_source"),
            "source_size",
            "target",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("_epochs"),
            F.round("target").cast("long").alias("_goal"),
            F.greatest(F.lit(1), F.ceil(F.col("_rows") / BIN_ROWS)).cast("long").alias("_bins"),
        ).withColumn("_left", F.col("_goal") - F.col("_epochs") * F.col("source_size")), "budget")
        budget = workspace.small_side(budget, 160)
        if quality is not None:
            best = quality.groupBy("doc_id").agg(F.max("weight").alias("_weight"))
            rows = rows.join(best.select(F.col("doc_id").alias("_id"), "_weight"), F.col("doc_id") == F.col("_id"), "left").drop("_id")
        else:
            rows = rows.withColumn("_weight", F.lit(None).cast("double"))
        # u ** (1 / weight), the largest first, is -log(u) / weight, the smallest first; exp(-key) is spread over (0, 1)
        key = -F.log(uniform(F.col("doc_id"), F.when(F.col("doc_id").isNull(), F.col("_hash")).otherwise(F.col("size")), seed=seed)) / F.coalesce(F.col("_weight"), F.lit(1.0))
        drawn = rows.withColumn("_key", key).join(budget, F.col("source").eqNullSafe(F.col("_source")))
        drawn = drawn.withColumn("_bin", F.floor((1 - F.exp(-F.col("_key"))) * F.col("_bins")).cast("long"))
        drawn = scratch.table(drawn.drop("_weight", "_source"), "drawn")
        sums = scratch.table(drawn.groupBy("source", "_bin", "_left").agg(F.sum("size").alias("_in")), "bins")
        up_to = F.sum("_in").over(Window.partitionBy("source").orderBy("_bin"))
        ends = scratch.table(sums.withColumn("_to", up_to).where("_to > _left and _to - _in <= _left").select(F.col("source").alias("_source"), F.col("_bin").alias("_end"), (F.col("_left") - F.col("_to") + F.col("_in")).alias("_room")), "ends")
        ends = ends.groupBy("_source").agg(F.min(F.struct("_end", "_room")).alias("e")).select("_source", "e._end", "e._room")
        met = drawn.join(workspace.small_side(ends, 80), F.col("source").eqNullSafe(F.col("_source")), "left")
        whole, none = F.col("size"), F.lit(0).cast("long")
        done = met.where("_end is null or _bin != _end").withColumn("_more", F.when(F.col("_end").isNull() | (F.col("_bin") < F.col("_end")), whole).otherwise(none))
        order = Window.partitionBy("source").orderBy("_key", F.col("doc_id").asc_nulls_last(), "size", "_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        over = F.col("_room") - (F.sum("size").over(order) - F.col("size"))  # words left when the document's turn comes
        last = F.greatest(none, F.least(whole, over)) if split else F.when((over > 0) & (2 * over >= whole), whole).otherwise(none)
        edge = met.where("_bin = _end").withColumn("_more", last)
        taken = (F.col("_epochs") * F.col("size") + F.col("_more")).alias("taken")
        return scratch.keep(done.unionByName(edge).select("doc_id", "size", "source_size", "target", taken))


def mixed(docs: DataFrame, quality: DataFrame | None = None, seed: int = 0) -> DataFrame:
    """The mix itself: docs' rows, all columns, each as often as it is taken, whole documents only.

    A document without words is in no mix.  Rows with the same doc_id are taken
    as often as the largest of them.
    """
    plan = mix(docs, quality, split=False, seed=seed)
    times = plan.where("size > 0").groupBy("doc_id").agg(F.max(F.floor(F.col("taken") / F.col("size"))).cast("int").alias("__iw_times")).where("__iw_times > 0")
    known = docs.join(workspace.small_side(times.withColumnRenamed("doc_id", "__iw_id"), 20), docs["doc_id"].eqNullSafe(F.col("__iw_id"))).drop("__iw_id")
    return known.where(words(F.col("text")) > 0).withColumn("__iw_nth", F.explode(F.sequence(F.lit(1), F.col("__iw_times")))).select(*docs.columns)
