"""Connected components of a graph given as links, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftspark.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least.withColumnRenamed("u", "n"), F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u <> v").union(least.select("u", F.col("m").alias("v")))


def _all_stars(links: DataFrame) -> bool:
    """Whether every node has one link at most, to a node that has none."""
    n, nodes = links.agg(F.count("*"), F.count_distinct("u")).first()
    return n == nodes and links.join(links.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every end of a link in ``links`` (two columns of longs); the root is the component's least node.

    A null end makes no link; repeated links and loops do no harm. Each round is stored in the shared folder.
    The number of rounds grows with the logarithm of the longest path, no step gathers a component.
    """
    a, b = links.columns
    ends = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    # stored first, as a round reads its links several times
    current = stored(ends.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")), "links").distinct()
    while not _all_stars(current):
        current = stored(_small_star(_large_star(current).distinct()).distinct(), "links")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(current.select("v", "v").distinct())
