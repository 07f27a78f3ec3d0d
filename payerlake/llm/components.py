"""Connected components of a link table, by alternating stars.

Each round points every node's larger neighbours at its smallest one and then, for every node,
its smaller neighbours at the smallest of them; the links end as stars around each component's
smallest node. A round is two joins and grouped minima over the links, written to the shared
scratch folder, and one count that tells if they are stars, which ends it; no component is ever
gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import narrow, store


def _large_star(links: DataFrame) -> DataFrame:
    # A link gives two rows at most; what comes twice goes with the small star's distinct.
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("least"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Links a > b. Every b of a node and the node itself are pointed at the node's least b."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    around = links.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return around.unionAll(least.select("a", F.col("least").alias("b"))).distinct()


def _are_stars(links: DataFrame) -> bool:
    """Whether each a of the links a > b has one link, and is no other node's b."""
    ends = links.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")),
                                          F.struct(F.col("b").alias("node"), F.lit(0).alias("up")))).alias("end")).select("end.*")
    node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return not node.agg(F.count_if((F.col("up") > 1) | (F.col("up") > F.col("least")))).first()[0]


def stars(links: DataFrame) -> DataFrame:
    """Links a > b of each node but the smallest of a component to that one, for links (a, b) of any
    order and number, which are read in each step of a round: a stored table, or a cheap select of one.

    Nodes without links do not appear; loops and repeated links do no harm; no links give no rows.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    while not _are_stars(links):
        links = store(narrow(_small_star(_large_star(links))), "links")
    return links


def merged(links: DataFrame, found: DataFrame) -> DataFrame:
    """The stars ``links`` after further links ``found`` between their components, which are named by their smallest
    nodes: the work is that of the components found linked, and one pass over the stars. ``found`` is read as ``stars`` does."""
    joined = stars(found)
    onto = joined.select(F.col("a").alias("b"), F.col("b").alias("onto"))
    moved = links.join(onto, "b", "left").select("a", F.coalesce("onto", "b").alias("b"))
    return store(narrow(moved.unionAll(joined)), "links")


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) for each node of links (a, b), which are stored first; else as ``stars``."""
    links = stars(store(links.select("a", "b"), "links"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .unionAll(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
