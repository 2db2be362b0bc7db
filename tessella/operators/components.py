"""Connected components: of links between nodes, and of a grid's cells by their runs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella import session
from tessella.operators import intervals


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node and component, its smallest node, of every node of links(a, b: numbers without nulls); a link of a node with itself names the node.

    In turn each node's larger neighbours, and then its smaller ones, are tied to the smallest node around it, until nothing moves: a number of rounds that grows with the logarithm of the
    longest way. Every round is two aggregations and joins over the links that are left, written to the shared folder. Inside a scratch block.
    """
    nodes = session.cut(links.select(F.col(a).alias("node")).unionByName(links.select(F.col(b).alias("node"))).distinct())
    edges = session.cut(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = session.cut(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))  # v < u: the smaller neighbours
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = session.cut(small.filter("u <> v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    return nodes.join(edges.groupBy("u").agg(F.min("v").alias("m")), F.col("node") == F.col("u"), "left").select("node", F.coalesce("m", "node").alias("component"))


def cell_components(cells: DataFrame, keys: list[str], x: str, y: str, diagonal: bool = True) -> DataFrame:
    """keys, area, x0, y0, x1, y1 (the last two exclusive) of the components of a grid's cells (keys, x, y: whole numbers, repeated cells count once).

    A row's neighbouring cells are one run, and only runs of rows that follow each other are compared, those that share a bucket of columns: components
    are those of the runs' links. diagonal: cells that touch at a corner are neighbours.
    """
    reach = 1 if diagonal else 0
    with session.scratch(cells.sparkSession):
        once = cells.select(*keys, F.col(x).cast("long").alias("x"), F.col(y).cast("long").alias("y")).distinct()
        runs = intervals.islands(once, [*keys, "y"], ["x"], "x", 1, F.min("x").alias("x0"), (F.max("x") + 1).alias("x1"))
        runs = session.cut(runs.withColumn("id", F.monotonically_increasing_id()))
        width = max(1, int(runs.agg(F.avg(F.col("x1") - F.col("x0"))).first()[0] or 1))
        upper = intervals.bucketed(runs.select(*keys, "y", "x0", "x1", "id"), "x0", "x1", width)
        lower = intervals.bucketed(runs.select(*keys, (F.col("y") - 1).alias("y"), (F.col("x0") - reach).alias("l0"), (F.col("x1") + reach).alias("l1"), F.col("id").alias("below")), "l0", "l1", width)
        met = upper.join(lower, [*keys, "y", "bucket"]).filter((F.col("x0") < F.col("l1")) & (F.col("l0") < F.col("x1"))).select("id", "below").distinct()
        part = components(met.unionByName(runs.select("id", F.col("id").alias("below"))), "id", "below")
        whole = runs.join(part, F.col("id") == F.col("node")).groupBy(*keys, "component")
        out = whole.agg(F.sum(F.col("x1") - F.col("x0")).alias("area"), F.min("x0").alias("x0"), F.min("y").alias("y0"), F.max("x1").alias("x1"), (F.max("y") + 1).alias("y1"))
        return out.drop("component").checkpoint(eager=True)

