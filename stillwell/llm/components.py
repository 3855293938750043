"""Connected components by alternating stars; labels are the smallest member."""

from pyspark.sql import DataFrame, functions as F

from stillwell.llm.common import stored

ROUNDS = 60
#: Nodes with at least so many links, or this share of all, are joined apart: at most 2 / share.
HEAVY, HEAVY_SHARE = 1000, 1e-3


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b). Nothing is gathered by node: minima are
    combined before the shuffle and joined back, those of the few heaviest nodes by a broadcast."""
    edges = stored(edges.filter("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    mark, count = None, edges.count()
    for _ in range(ROUNDS):
        # Large star: neighbours above a node are hung on the smallest neighbour.
        ways = _both(edges)
        least = stored(ways.groupBy("a").agg(
            F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("n")), "least")
        above = ways.filter("b > a")
        limit = max(HEAVY, int(count * HEAVY_SHARE))
        heavy = F.broadcast(least.filter(F.col("n") >= limit).select("a", "m"))
        met = above.join(heavy, "a").select("m", "b").unionByName(
            above.join(heavy.select("a"), "a", "left_anti")
            .join(least.filter(F.col("n") < limit).select("a", "m"), "a").select("m", "b"))
        large = met.select(F.col("m").alias("a"), "b").filter("a <> b").distinct()
        large = stored(large, "large-star")
        # Small star: a node and its smaller neighbours are hung on the smallest of them.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(least, "b")
        small = joined.select(F.col("m").alias("a"), "b").unionByName(
            joined.select(F.col("m").alias("a"), F.col("a").alias("b")))
        edges = stored(small.filter("a <> b").distinct(), "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark, count = now, now[0]
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("a").alias("node")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(
        roots.select("node", F.col("node").alias("label")))
