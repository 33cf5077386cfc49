"""Connected components of a table of links, in Spark: alternating large-star and small-star steps.

No node gathers its links in one row: a step is a minimum per node (partial sums first) and a join back, which Spark can
split where one node has very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import materialise, release


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links (a > b). Large: a node's larger neighbours move to its least one; small: its smaller ones do, with itself."""
    if large:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        moved = both.filter("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = links.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        near = links.join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = near.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 50) -> DataFrame:
    """node, root: for each node of links, the least node of its component; links of a node with itself are ignored.

    The two steps halve the longest distance or better, so most_rounds is reached by no table; if it is, that is an error.
    """
    now = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    now = materialise(now, "links")
    state = None
    for _ in range(most_rounds):
        last, now = now, materialise(_star(_star(now, True), False), "links")
        release(last)
        new = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if new == state:
            break
        state = new
    else:
        raise RuntimeError(f"components haven't settled after {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
