"""Connected components of a graph of edges, by alternating large-star and small-star steps.

Both steps are an aggregate and a join, so that no neighbourhood is ever collected. Nodes with more than a
partition's share of the edges, of which there are few (see meet), meet their edges by broadcast and the
others by a shuffle, so no hub meets in one task and no plan needs to be changed while it runs. Each step is written to
the checkpoint folder; partitions follow the number of edges. The rounds end as soon as all that is left are stars.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella import session

EDGES = 50_000  # of a partition
HEAVY = 1000  # edges of a node from which on it may be broadcast


def meet(left: DataFrame, right: DataFrame, on: str, weight: str) -> DataFrame:
    """left joined with right, which has a row a key `on` and in `weight` the rows that left has of it.

    Keys with more than a partition's share of the rows, one a partition at most, meet by broadcast, the others by a shuffle.
    right is read several times: it is to be written before.
    """
    parts = session.parts(left.sparkSession)
    most, total = right.agg(F.max(weight), F.sum(weight)).first()
    bound = max(HEAVY, (total or 0) // parts)
    if (most or 0) <= bound:
        return left.join(right, on)
    heavy = F.broadcast(right.filter(F.col(weight) > bound))
    light = left.join(heavy.select(on), on, "left_anti").join(right.filter(F.col(weight) <= bound), on)
    out = left.join(heavy, on)
    return out.unionByName(light.select(*out.columns))


def components(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node that it reaches) of every node of edges(a, b); null ends and loops are left out.

    To be called in a scratch block, where the tables of the rounds are deleted at the end.
    """
    spark = edges.sparkSession
    parts = session.parts(spark)
    e = session.cut(edges.filter("a is not null and b is not null and a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    n = e.count()
    few = max(1, min(parts, n // EDGES))
    # adaptive execution starts a thread an exchange, and these are many and small
    with session.settings(spark, adaptive_enabled="false", shuffle_partitions=min(parts, max(8, few))):
        while n:
            both = e.select(F.col("a").alias("v"), F.col("b").alias("w"), F.lit(1).alias("up")).unionByName(e.select(F.col("b").alias("v"), F.col("a").alias("w"), F.lit(0).alias("up")))
            low = both.groupBy("v").agg(F.min("w").alias("m"), F.count("*").alias("deg"), F.sum("up").alias("up")).select("v", F.least("v", "m").alias("m"), "deg", "up")
            low = session.cut(low.coalesce(few))
            # a star's outer nodes have its centre, which is smaller, and nothing else
            if low.filter("up > 0 and deg > 1").isEmpty():
                break
            # large star: the larger end of an edge goes to the smallest neighbour of the smaller one
            large = meet(e, low.select(F.col("v").alias("b"), "m", (F.col("deg") - F.col("up")).alias("n")).filter("n > 0"), "b", "n")
            large = session.cut(large.select("a", F.col("m").alias("b")).distinct().coalesce(few))
            # small star: smaller neighbours and the node go to the smallest one
            low = session.cut(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).coalesce(few))
            small = meet(large, low, "a", "n").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            e = session.cut(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct().coalesce(few))
            n = e.count()
        star = e.select(F.col("a").alias("node"), F.col("b").alias("label"))
        return session.cut(star.unionByName(star.select(F.col("label").alias("node"), "label").distinct()).coalesce(few))
