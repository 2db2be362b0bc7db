"""Column layout: headwords, tallies, windows and cuts from runs (arrays of structs s, e in rising order), box placement and clamping.

Nulls: a null array has no runs. Lengths are in the unit of the runs; `slot` is a character's height.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def headword(runs: Column, slot: float) -> Column:
    """struct(s, e) of a column's headword: its first run, if that starts within 0.45 slots, and the following ones that end within 2.12 slots; cut to two slots beyond 2.25, null below 1.2."""
    first = F.get(runs, F.lit(0))
    inside = F.array_max(F.transform(F.filter(runs, lambda r: r["e"] <= 2.12 * slot), lambda r: r["e"]))
    end = F.greatest(first["e"], F.coalesce(inside, first["e"]))
    high = end - first["s"]
    cut = F.when(high > 2.25 * slot, first["s"] + 2 * slot).otherwise(end.cast("double"))
    return F.when((first["s"] <= 0.45 * slot) & (high >= 1.2 * slot), F.struct(first["s"].cast("double").alias("s"), cut.alias("e")))


def flat_headword(runs: Column, slot: float) -> Column:
    """Whether a column begins with a flat character: a first run lower than 0.35 slots around the middle of the first two and the next one from 1.8 slots on."""
    a, b = F.get(runs, F.lit(0)), F.get(runs, F.lit(1))
    return F.coalesce((a["e"] - a["s"] < 0.35 * slot) & ((a["s"] + a["e"]) / 2).between(0.6 * slot, 1.25 * slot) & (b["s"] >= 1.8 * slot), F.lit(False))


def tally(runs: Column, slot: float) -> Column:
    """Whether a column (without a seal) is a tally: two runs or more, the first indented by 2.5 slots."""
    return F.coalesce((F.size(runs) >= 2) & (F.get(runs, F.lit(0))["s"] >= 2.5 * slot), F.lit(False))


def windows(runs: DataFrame, start: str, end: str, slot: int) -> DataFrame:
    """Adds s, e: windows of two slots, a quarter apart, over runs of at least that length."""
    long = runs.filter(F.col(end) - F.col(start) >= 2 * slot)
    return long.withColumn("s", F.explode(F.sequence(F.col(start), F.col(end) - 2 * slot, F.lit(slot // 4).cast("long")))).withColumn("e", F.col("s") + 2 * slot)


def valleys(profile: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """keys, cut: the middles of the runs of places whose value is at most 2 or 0.3 of their group's median, the larger of the two."""
    low = profile.join(profile.groupBy(*keys).agg(F.greatest(F.lit(2.0), 0.3 * F.median(value)).alias("most")), keys).filter(F.col(value) <= F.col("most"))
    run = F.col(at) - F.row_number().over(Window.partitionBy(*keys).orderBy(at))
    return low.withColumn("run", run).groupBy(*keys, "run").agg(F.floor((F.min(at) + F.max(at)) / 2).alias("cut")).drop("run")


def cut_pairs(cuts: DataFrame, keys: list[str], low: float, high: float) -> DataFrame:
    """keys, s, e: pairs of cuts whose distance is between low and high; the frame is bounded by the distance."""
    near = Window.partitionBy(*keys).orderBy("cut").rangeBetween(0, int(high))
    pairs = cuts.withColumn("ends", F.collect_list("cut").over(near)).select(*keys, F.col("cut").alias("s"), F.explode("ends").alias("e"))
    return pairs.filter((F.col("e") - F.col("s")).between(low, high))


def column_of(centre: Column, rules: Column) -> Column:
    """The number, counted from the right, of the column between two rules (a rising array) that holds a centre; null outside."""
    n = F.size(rules) - 1
    index = F.size(F.filter(rules, lambda r: r <= centre)) - 1
    return F.when((index >= 0) & (index < n), n - 1 - index).cast("long")


def view_window(x: Column, y: Column, w: Column, h: Column, pad_x: int = 110, pad_y: int = 130) -> Column:
    """The part of a page around a box that is shown: from 0 at least."""
    left, top = F.greatest(x - pad_x, F.lit(0)), F.greatest(y - pad_y, F.lit(0))
    return F.struct(left.alias("x"), top.alias("y"), (x + w + pad_x - left).alias("w"), (y + h + pad_y - top).alias("h"))


def drawn_box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A box from two corners in any order, two wide and high at least."""
    return F.struct(F.least(x0, x1).alias("x"), F.least(y0, y1).alias("y"), F.greatest(F.abs(x1 - x0), F.lit(2)).alias("w"), F.greatest(F.abs(y1 - y0), F.lit(2)).alias("h"))


def clamped_crop(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column, pad: int, size: int) -> Column:
    """A padded crop inside its page and the scale that makes its longer side `size`, never above 1; null where nothing is left."""
    x0, y0 = F.greatest(x - pad, F.lit(0)), F.greatest(y - pad, F.lit(0))
    x1, y1 = F.least(x + w + pad, width), F.least(y + h + pad, height)
    scale = F.least(F.lit(1.0), size / F.greatest(x1 - x0, y1 - y0))
    return F.when((x1 > x0) & (y1 > y0), F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"), F.round(scale, 6).alias("scale")))


def tight_box(cells: DataFrame, keys: list[str], x: str, y: str, ink: Column) -> DataFrame:
    """keys, x0, y0, x1, y1 (half-open) of the cells with ink; groups without any have no row."""
    return cells.filter(ink).groupBy(*keys).agg(F.min(x).alias("x0"), F.min(y).alias("y0"), (F.max(x) + 1).alias("x1"), (F.max(y) + 1).alias("y1"))


def merged(parts: list[tuple[int, DataFrame]], group: list[str], order: list[str]) -> DataFrame:
    """Rows of several frames of equal columns in one order a group: by `order`, frames with a lower rank first at ties; ord counts from 1."""
    out = None
    for rank, df in parts:
        df = df.withColumn("rank_", F.lit(rank))
        out = df if out is None else out.unionByName(df)
    place = [F.asc_nulls_first(c) for c in order]
    k = order.index("y0") if "y0" in order else len(order)
    w = Window.partitionBy(*group).orderBy(*place[:k], "rank_", *place[k:])
    return out.withColumn("ord", F.row_number().over(w).cast("long")).drop("rank_")


def suppress_seeded(candidates: DataFrame, taken: DataFrame, keys: list[str], score: str, ident: str, limit: float, overlap) -> DataFrame:
    """Candidates (s, e) by falling score that overlap neither what is taken nor a candidate kept before by more than limit.

    A key is a column of a page, a bounded unit, so its rows meet in one array.
    """
    seeds = taken.groupBy(*keys).agg(F.collect_list(F.struct("s", "e")).alias("seed"))
    rows = candidates.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct((-F.col(score)).alias("k"), F.col(ident).alias("id"), "s", "e"))).alias("rows"))
    j = rows.join(seeds, keys, "left").withColumn("seed", F.coalesce("seed", F.expr("filter(transform(rows, x -> named_struct('s', x.s, 'e', x.e)), y -> false)")))
    start = F.struct(F.col("seed").alias("seen"), F.filter("rows", lambda x: F.lit(False)).alias("kept"))

    def step(acc, x):
        free = ~F.exists(acc["seen"], lambda y: overlap(x["s"], x["e"], y["s"], y["e"]) > limit)
        return F.when(free, F.struct(F.array_append(acc["seen"], F.struct(x["s"].alias("s"), x["e"].alias("e"))).alias("seen"), F.array_append(acc["kept"], x).alias("kept"))).otherwise(acc)

    return j.select(*keys, F.explode(F.aggregate("rows", start, step)["kept"]).alias("x")).select(*keys, F.col("x.id").alias(ident), "x.s", "x.e", (-F.col("x.k")).alias(score))
