"""Runs, intervals and boxes: islands, overlaps, greedy suppression."""

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella import session
from tessella.functions import scalars as S


def islands(df: DataFrame, keys: list[str], order: list[str], at: str, gap, *aggs: Column) -> DataFrame:
    """Groups of rows whose neighbours in `at` are at most `gap` apart, each with the aggregates."""
    w = Window.partitionBy(*keys).orderBy(*order)
    new = F.when(F.col(at) - F.lag(at).over(w) > gap, 1).otherwise(0)
    numbered = df.withColumn("new_", new).withColumn("island", F.sum("new_").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "island").agg(*aggs).drop("island")


def true_runs(df: DataFrame, keys: list[str], at: str, merge: int, least: int) -> DataFrame:
    """Half-open runs of the integer places in `at`: first merged over up to `merge` missing places, then dropped below `least` places."""
    runs = islands(df, keys, [at], at, merge + 1, F.min(at).alias("start"), (F.max(at) + 1).alias("end"))
    return runs.filter(F.col("end") - F.col("start") >= least)


def overlap_clusters(df: DataFrame, keys: list[str], start: str, end: str, ident: str) -> DataFrame:
    """Adds `cluster`: intervals that touch, directly or along others, have one number in their key."""
    w = Window.partitionBy(*keys).orderBy(start, ident)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col(start) >= reach, 1).otherwise(0)
    return df.withColumn("new_", new).withColumn("cluster", F.sum("new_").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("new_")


def suppress(df: DataFrame, keys: list[str], start: str, end: str, score: str, ident: str, limit: float) -> DataFrame:
    """Greedy suppression: by falling score, an interval stays if it overlaps none that stays by more than `limit` of the shorter one.

    Only intervals of one cluster can overlap, so the fold runs over clusters and not over whole keys.
    """
    row = F.struct((-F.col(score)).alias("k"), F.col(ident).alias("id"), F.col(start).alias("s"), F.col(end).alias("e"))
    groups = overlap_clusters(df, keys, start, end, ident).groupBy(*keys, "cluster").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    empty = F.filter("rows", lambda x: F.lit(False))
    kept = F.aggregate("rows", empty, lambda acc, x: F.when(F.exists(acc, lambda y: S.overlap_shorter(x["s"], x["e"], y["s"], y["e"]) > limit), acc).otherwise(F.concat(acc, F.array(x))))
    return groups.select(*keys, F.explode(kept).alias("x")).select(*keys, F.col("x.id").alias(ident), F.col("x.s").alias(start), F.col("x.e").alias(end), (-F.col("x.k")).alias(score))


def suppress_rounds(df: DataFrame, keys: list[str], start: str, end: str, score: str, ident: str, limit: float) -> DataFrame:
    """suppress() in rounds, for clusters of any size: in each one, the intervals that are the best of every bucket they reach stay,
    and what overlaps one of them by more than `limit` of the shorter one goes.

    Whatever overlaps an interval shares a bucket with it, so such an interval beats all that it overlaps and a fold would keep it; a bucket has
    one best interval, so each interval meets one other a bucket and no pairs of a cluster are made. Buckets are as wide as intervals are on average, so that there are at
    most some three rows an interval. The best of a key is always kept, so rounds come to an end; keys and ids are not null, and ids are unique in a key.
    """
    rank = F.struct((-F.col(score)).alias("k_"), F.col(ident).alias("id_"), F.col(start).alias("s_"), F.col(end).alias("e_"))
    with session.scratch(df.sparkSession):
        alive = session.cut(df.select(*keys, ident, start, end, score))
        width = max(1, int(alive.agg(F.avg(F.col(end) - F.col(start))).first()[0] or 1))
        reached = F.floor(F.greatest(F.col("b.e_") - 1, F.col("b.s_")) / width) - F.floor(F.col("b.s_") / width) + 1
        kept = []
        while not alive.isEmpty():
            spread = bucketed(alive, start, end, width)
            best = session.cut(spread.groupBy(*keys, "bucket").agg(F.min(rank).alias("b")))
            stay = session.cut(best.groupBy(*keys, "b").agg(F.count("*").alias("n")).filter(F.col("n") == reached).select(*keys, "b.*"))
            kept.append(stay)
            near = bucketed(stay, "s_", "e_", width)  # at most one a bucket
            met = spread.join(near, [*keys, "bucket"]).filter((F.col(ident) == F.col("id_")) | (S.overlap_shorter(F.col(start), F.col(end), F.col("s_"), F.col("e_")) > limit))
            alive = session.cut(alive.join(met.select(*keys, ident).distinct(), [*keys, ident], "left_anti"))
        out = functools.reduce(DataFrame.unionByName, kept) if kept else alive.select(*keys, (-F.col(score)).alias("k_"), F.col(ident).alias("id_"), F.col(start).alias("s_"), F.col(end).alias("e_"))
        return out.select(*keys, F.col("id_").alias(ident), F.col("s_").alias(start), F.col("e_").alias(end), (-F.col("k_")).alias(score)).checkpoint(eager=True)


def bucketed(df: DataFrame, start: str, end: str, width: int) -> DataFrame:
    """One row for each bucket of `width` that an interval reaches, which makes overlap joins equi-joins."""
    first, last = F.floor(F.col(start) / width), F.floor(F.greatest(F.col(end) - 1, F.col(start)) / width)
    return df.withColumn("bucket", F.explode(F.sequence(first, last)))


def iou_label(found: DataFrame, known: DataFrame, keys: list[str], ident: str, width: int, high: float = 0.8, low: float = 0.3) -> DataFrame:
    """1 for intervals like a known one (IoU >= high), 0 for those unlike all (<= low); the rest goes. Both sides have keys, s, e."""
    k = bucketed(known.select(*keys, F.col("s").alias("ks"), F.col("e").alias("ke")), "ks", "ke", width)
    joined = bucketed(found, "s", "e", width).join(k, [*keys, "bucket"], "left")
    iou = S.interval_iou(F.col("s"), F.col("e"), F.col("ks"), F.col("ke"))
    best = joined.groupBy(*keys, ident).agg(F.max(F.when(F.col("ks").isNull(), 0.0).otherwise(iou)).alias("iou"))  # least() and greatest() pass over nulls
    label = F.when(F.col("iou") >= high, 1).when(F.col("iou") <= low, 0)
    return best.withColumn("label", label.cast("long")).filter("label is not null")


def run_pairs(df: DataFrame, keys: list[str], low, high, most_gap) -> DataFrame:
    """Pairs (first run, last run) of runs s, e whose span is between low and high, and between which no gap is over most_gap."""
    w = Window.partitionBy(*keys).orderBy("s")
    new = F.when(F.col("s") - F.lag("e").over(w) > most_gap, 1).otherwise(0)
    chained = df.withColumn("new_", new).withColumn("chain", F.sum("new_").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # only runs that begin within `high` can end a pair, so the frame is bounded by the span and not by the key
    near = Window.partitionBy(*keys, "chain").orderBy("s").rangeBetween(0, high)
    pairs = chained.withColumn("ends_", F.collect_list("e").over(near))
    return pairs.select(*keys, "s", F.explode("ends_").alias("e")).filter((F.col("e") - F.col("s")).between(low, high))
