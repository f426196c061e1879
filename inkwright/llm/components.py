"""Connected components of links too many for one machine (large-star, small-star).

Kiveris et al., 2014: every node's larger neighbours are linked to its smallest
one, then its smaller ones likewise, until each component is a star around its
smallest node.  A node's smallest neighbour comes from a pre-aggregated minimum;
these minima, no more than two a link, are broadcast where the counted links prove
them small, else they are a table of their own, so that Spark can split the links of
a node that has very many.  Each step's links are a written table, so neither
lineage nor driver memory grows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from inkwright.llm import workspace


def components(links: DataFrame, scratch: workspace.Scratch, most_rounds: int = 60) -> DataFrame:
    """Rows (node, root) of links (a, b): each linked node and the smallest it can reach. Nodes without links have none."""
    star, state = _written(_oriented(links).distinct(), scratch)
    for _ in range(most_rounds if state[0] else 0):
        star, now = _written(_small(_large(star, state[0], scratch), state[0], scratch), scratch)
        if now == state:
            break
        state = now
    else:
        if state[0]:
            raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    nodes = star.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return scratch.table(nodes.unionByName(star.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()), "components")


def _written(star: DataFrame, scratch: workspace.Scratch) -> tuple[DataFrame, tuple]:
    """The links as a table, with their count and order-free hashes: these are equal before and after a round only at the end."""
    seen = Observation()
    marked = star.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64("b", "a")).alias("x"))
    table = scratch.table(marked, "links")
    return table, (seen.get["n"], seen.get["s"], seen.get["x"])


def _oriented(links: DataFrame) -> DataFrame:
    return links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _minima(least: DataFrame, links: int, scratch: workspace.Scratch) -> DataFrame:
    """A row for each node of so many links, as a side of a join with them."""
    return F.broadcast(least) if 2 * links * NODE_BYTES <= workspace.BROADCAST_BYTES else scratch.table(least, "least")


def _large(star: DataFrame, links: int, scratch: workspace.Scratch) -> DataFrame:
    """Each link's smaller node gives way to its own smallest neighbour; where it has no smaller one, the link stays."""
    least = star.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    return star.join(_minima(least, links, scratch), star["b"] == F.col("node"), "left").select("a", F.coalesce("m", "b").alias("b")).where("a != b")


def _small(star: DataFrame, links: int, scratch: workspace.Scratch) -> DataFrame:
    """Nodes with several smaller neighbours link these to the smallest one and keep that one."""
    down = _oriented(star)
    least = down.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    several = _minima(least.where("n > 1").select("a", "m"), links, scratch)
    moved = down.join(several, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _oriented(moved).unionByName(least.select("a", F.col("m").alias("b"))).distinct()


#: A node and its minimum, at most (binary ids take 16 bytes and their headers).
NODE_BYTES = 64
PIVOTS = 4
ROUNDS = 2


def link_large(many: DataFrame, links: DataFrame, verify: Callable[[DataFrame], DataFrame], scratch: workspace.Scratch, rounds: int = ROUNDS, rest: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """links (a, b) and those that large groups add, of rows (band, id) of which those in one band may be linked.

    ``verify`` keeps the pairs (a, b) that are links.  First each member of a
    band meets a few pivots; links merge members into components.  Members that
    are not in their band's largest component meet new pivots for some rounds,
    and those that still remain meet all others of the band.  In the end, all
    pairs of a band were compared or are in one component, so components are
    those of all pairs; a band whose members belong together costs a number of
    pairs in proportion to its size.  ``rest``, if given, finds what is left after
    the rounds instead: from rows (band, id, root) of the bands with several
    components, links that connect all that belong together.
    """
    roots = components(links, scratch) if rest is None else None  # with rest, the first pivots meet all members, and components are found once less
    for turn in range(rounds + 1):
        state = many.join(roots, many["id"] == roots["node"], "left").select("band", "id", F.coalesce("root", "id").alias("root")) if roots is not None else many.select("band", "id", F.col("id").alias("root"))
        state = scratch.table(state, "state")
        by_root = state.groupBy("band", "root").agg(F.count("*").alias("n"))
        main = by_root.groupBy("band").agg(F.max(F.struct("n", "root")).alias("m"), F.count("*").alias("roots")).where("roots > 1")
        main = scratch.table(main.select("band", F.col("m.root").alias("main")), "main")
        if main.isEmpty():
            break
        split = scratch.table(state.join(main, "band"), "split")
        if turn == rounds and rest is not None:
            return links.unionByName(rest(split.select("band", "id", "root")))
        lone = split.where("root != main").select("band", F.col("id").alias("a"), F.col("root").alias("ra"))
        if turn < rounds:  # pivots have the least hashes, others in each round; partial minima pick them
            salted = split.withColumn("_k", F.xxhash64(F.lit(turn), "id")).withColumn("_s", F.pmod("_k", F.lit(PIVOTS)))
            pivots = salted.groupBy("band", "_s").agg(F.min(F.struct("_k", "id", "root")).alias("p")).select("band", F.col("p.id").alias("b"), F.col("p.root").alias("rb"))
            every = lone if turn else split.select("band", F.col("id").alias("a"), F.col("root").alias("ra"))
        else:
            pivots = split.select("band", F.col("id").alias("b"), F.col("root").alias("rb"))
            every = lone
        meet = every.join(pivots, "band").where("ra != rb").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        found = verify(scratch.table(meet, "pairs"))
        if turn < rounds:
            known = links if roots is None else roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
            roots = components(found.unionByName(known), scratch)
        links = links.unionByName(found)
    return links
