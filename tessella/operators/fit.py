"""Profiles and fits: exact quantiles, guards, smoothing, local maxima, trimmed regression, grid search and its repair."""

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella import session


MOST = 4096  # values that are sorted in one row
BROADCAST = 100_000  # rows of targets that are sent to all tasks; beyond, they are joined by key


def _reached(rows: DataFrame, keys: list[str], targets: DataFrame, *columns: str) -> DataFrame:
    """The rows (keys, v_) within each target's bounds lo and hi, with the target's columns; targets go to the rows, which are not shuffled, unless they are many."""
    small = F.broadcast(targets) if targets.limit(BROADCAST + 1).count() <= BROADCAST else targets
    t = small.select(*[F.col(k).alias(f"{k}_t") for k in keys], "r", "lo", "hi", *columns)
    same = functools.reduce(lambda x, k: x & F.col(k).eqNullSafe(F.col(f"{k}_t")), keys, F.col("v_").between(F.col("lo"), F.col("hi")))
    return rows.join(t, same)


def select_ranks(rows: DataFrame, keys: list[str], targets: DataFrame, most: int = MOST) -> DataFrame:
    """keys, r and v: the value of rank r (from 0) among the rows (keys, v_: numbers, no nulls) of each target's group.

    targets: keys, r, n (rows of the group), lo and hi (its least and largest value). Each pass takes a few cut values around the rank from a sketch,
    counts exactly what lies below, between and above them, and goes on with the stretch that holds the rank, until it has `most`
    rows or one value. A sketch that misses costs a pass and never the result; groups of any size are counted in part in every task,
    and no more than `most` values meet in a row. Inside a scratch block.
    """
    state = session.cut(targets.select(*keys, "r", F.col("lo").cast("double").alias("lo"), F.col("hi").cast("double").alias("hi"), F.lit(0).cast("long").alias("below"), F.col("n").cast("long").alias("inside")))
    done = state.filter((F.col("inside") <= most) | (F.col("lo") == F.col("hi")))
    parts = 64
    while not (rest := state.filter((F.col("inside") > most) & (F.col("lo") < F.col("hi")))).isEmpty():
        group = [*keys, "r", "lo", "hi", "below", "inside"]
        cuts = _reached(rows, keys, rest, "below", "inside").groupBy(*group).agg(F.percentile_approx("v_", [i / parts for i in range(parts + 1)], 20 * parts).alias("c"))
        at = F.floor((F.col("r") - F.col("below") + 0.5) / F.col("inside") * parts).cast("int")
        near = cuts.select(*group, *[F.get("c", F.greatest(F.least(at + d, F.lit(parts)), F.lit(0))).alias(x) for d, x in ((-1, "a"), (0, "p"), (2, "b"))])
        near = session.cut(near)
        v, a, p, b = map(F.col, ("v_", "a", "p", "b"))
        zones = [v < a, (v >= a) & (v < p), v == p, (v > p) & (v <= b), v > b]  # p is a value of the stretch, so every zone is smaller
        found = [f(F.when(z, v)).alias(f"{x}{i}") for i, z in enumerate(zones) for f, x in ((F.count, "n"), (F.min, "lo"), (F.max, "hi"))]
        counted = _reached(rows, keys, near, "below", "inside", "a", "p", "b").groupBy(*group).agg(*found)
        left, new = F.col("r") - F.col("below"), F.lit(None)
        for i in reversed(range(5)):
            before = sum((F.col(f"n{k}") for k in range(i)), F.lit(0))
            inner = F.struct(F.col(f"lo{i}").alias("lo"), F.col(f"hi{i}").alias("hi"), (F.col("below") + before).alias("below"), F.col(f"n{i}").alias("inside"))
            new = inner if i == 4 else F.when(left < before + F.col(f"n{i}"), inner).otherwise(new)
        state = session.cut(counted.select(*keys, "r", new.alias("new")).select(*keys, "r", "new.*"))
        done = done.unionByName(state.filter((F.col("inside") <= most) | (F.col("lo") == F.col("hi"))))
    done = session.cut(done)
    sorted_ = _reached(rows, keys, done.filter("lo < hi"), "below").groupBy(*keys, "r", "below").agg(F.array_sort(F.collect_list("v_")).alias("all"))
    picked = sorted_.select(*keys, "r", F.get("all", (F.col("r") - F.col("below")).cast("int")).alias("v"))
    return done.filter("lo = hi").select(*keys, "r", F.col("lo").alias("v")).unionByName(picked)


def quantiles(df: DataFrame, keys: list[str], value: str, **probs: float) -> DataFrame:
    """keys and a column for each name = probability: the exact quantile, linear between neighbouring values; nulls of the value are passed over, and null keys are a group."""
    with session.scratch(df.sparkSession):
        rows = df.select(*keys, F.col(value).cast("double").alias("v_")).filter("v_ is not null")
        ends = session.cut(rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("v_").alias("lo"), F.max("v_").alias("hi")))
        place = {c: (F.col("n") - 1) * F.lit(float(p)) for c, p in probs.items()}
        ranks = F.array_distinct(F.array(*[f(x).cast("long") for x in place.values() for f in (F.floor, F.ceil)]))
        found = select_ranks(rows, keys, ends.select("*", F.explode(ranks).alias("r"))).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("r", "v"))).alias("m"))
        both = ends.join(found.select(*[F.col(k).alias(f"{k}_f") for k in keys], "m"), functools.reduce(lambda x, k: x & F.col(k).eqNullSafe(F.col(f"{k}_f")), keys, F.lit(True)))
        pick = lambda x, f: F.element_at("m", f(x).cast("long"))
        out = both.select(*keys, *[(pick(x, F.floor) + (pick(x, F.ceil) - pick(x, F.floor)) * (x - F.floor(x))).alias(c) for c, x in place.items()])
        return out.checkpoint(eager=True)


def values_at(df: DataFrame, value: str, ranks: list[int], most: int = MOST) -> list:
    """The values of some ranks (from 0, below the number of rows) of a whole column without nulls."""
    with session.scratch(df.sparkSession):
        rows = df.select(F.col(value).cast("double").alias("v_"))
        ends = rows.agg(F.count("*").alias("n"), F.min("v_").alias("lo"), F.max("v_").alias("hi")).withColumn("r", F.explode(F.array(*[F.lit(r).cast("long") for r in sorted(set(ranks))])))
        found = {x.r: x.v for x in select_ranks(rows, [], ends, most).collect()}  # as many rows as ranks
        return [found[r] for r in ranks]


def _beside(df: DataFrame, named: DataFrame, keys: list[str]) -> DataFrame:
    """df with the columns of its group, a row a group: sent to all rows, which stay where they are, unless the groups are many."""
    return df.join(F.broadcast(named) if named.limit(BROADCAST + 1).count() <= BROADCAST else named, keys)


def median_guard(df: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """Rows whose value is more than `share` of their group's median away from it."""
    mid = quantiles(df, keys, value, mid=0.5)
    return _beside(df, mid, keys).filter(F.abs(F.col(value) - F.col("mid")) > share * F.col("mid"))


def contrast(df: DataFrame, keys: list[str], value: str, part: float) -> DataFrame:
    """Rows at or below p2 + (median - p2) * part of their group."""
    q = quantiles(df, keys, value, p2=0.02, mid=0.5)
    return _beside(df, q, keys).filter(F.col(value) <= F.col("p2") + (F.col("mid") - F.col("p2")) * part)


def smooth_cap(df: DataFrame, keys: list[str], at: str, value: str, reach: int, cap: float) -> DataFrame:
    """Adds smoothed: the sum over 2 * reach + 1 rows (fewer at the ends), not above cap times the group's largest sum."""
    w = Window.partitionBy(*keys).orderBy(at)
    s = df.withColumn("sum_", F.sum(value).over(w.rowsBetween(-reach, reach)))
    return s.withColumn("smoothed", F.least(F.col("sum_").cast("double"), cap * F.max("sum_").over(Window.partitionBy(*keys)))).drop("sum_")


def snap(df: DataFrame, keys: list[str], at: str, value: str, reach: int) -> DataFrame:
    """Adds peak_at: the place of the largest value within `reach` rows, the first one at ties."""
    w = Window.partitionBy(*keys).orderBy(at).rowsBetween(-reach, reach)
    return df.withColumn("peak_at", F.min(F.struct((-F.col(value)).alias("k"), F.col(at).alias("p"))).over(w)["p"])


def trimmed_line(df: DataFrame, keys: list[str], x: str, y: str, limit: float, rounds: int = 2, least: int = 40) -> DataFrame:
    """Slope and intercept by least squares, refitted after dropping rows further than `limit` from the line; a group left with fewer than `least` rows keeps its last fit."""
    def fit(d):
        return d.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.count("*").alias("n"))

    line, rest = fit(df), df
    for _ in range(rounds):
        near = rest.join(line.select(*keys, "slope", "intercept"), keys).filter(F.abs(F.col(y) - F.col("slope") * F.col(x) - F.col("intercept")) < limit).select(*df.columns)
        again = fit(near)
        new = line.alias("o").join(again.alias("n"), keys, "left")
        ok = F.col("n.n") >= least
        line = new.select(*keys, *[F.when(ok, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in ("slope", "intercept", "n")])
        rest = near
    return line


def grid_search(profile: DataFrame, keys: list[str], at: str, value: str, pitches: list[int], rules: int) -> DataFrame:
    """For each group the pitch and origin whose rules (origin + k * pitch) gather most, the ends counted twice.

    Every place of the profile is a candidate origin; each value is sent to the (pitch, origin) pairs that use it, so
    the search is an aggregate over len(pitches) * rules rows a place and no cross join of profiles with themselves.
    """
    spots = F.array(*[F.struct(F.lit(p).alias("pitch"), F.lit(k).alias("k")) for p in pitches for k in range(rules)])
    sent = profile.select(*keys, at, value, F.explode(spots).alias("g"))
    weight = F.when(F.col("g.k").isin(0, rules - 1), 2).otherwise(1)
    scored = sent.groupBy(*keys, F.col("g.pitch").alias("pitch"), (F.col(at) - F.col("g.k") * F.col("g.pitch")).alias("origin")).agg(F.sum(F.col(value) * weight).alias("score"))
    best = scored.groupBy(*keys).agg(F.min(F.struct((-F.col("score")).alias("k"), "pitch", "origin")).alias("b"))
    return best.select(*keys, F.col("b.pitch").alias("pitch"), F.col("b.origin").alias("origin"), (-F.col("b.k")).alias("score"))


def text_ratio(ink: DataFrame, grids: DataFrame, keys: list[str], at: str, value: str, columns: int) -> DataFrame:
    """grids (keys, origin, pitch and others) with ratio: ink in the middle halves of a grid's columns over ink in the halves around its rules, which counts as 1 at least.

    Every place between the outer rules is one row that meets its ink by key and place.
    """
    names = grids.columns
    a, b = F.col("origin") + F.col("pitch") * F.col("k"), F.col("origin") + F.col("pitch") * (F.col("k") + 1)
    quarter = (b - a) / 4
    whole = lambda x: x.cast("long")  # noqa: E731  towards zero
    bands = grids.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
    span = lambda lo, hi: F.when(hi > lo, F.sequence(lo, hi - 1)).otherwise(F.array().cast("array<bigint>"))
    inner, outer = span(whole(a + quarter), whole(b - quarter)), F.concat(span(whole(a), whole(a + quarter)), span(whole(b - quarter), whole(b)))
    places = bands.select(*names, F.explode(F.concat(F.transform(inner, lambda x: F.struct(F.lit(True).alias("mid"), x.alias("x"))), F.transform(outer, lambda x: F.struct(F.lit(False).alias("mid"), x.alias("x"))))).alias("s"))
    places = places.select(*names, "s.mid", F.col("s.x").alias(at))
    met = places.join(ink.select(*keys, at, F.col(value).alias("ink_")), [*keys, at], "left")
    part = lambda c: F.coalesce(F.sum(F.when(c, F.col("ink_"))), F.lit(0)).cast("double")
    return met.groupBy(*names).agg((part(F.col("mid")) / F.greatest(part(~F.col("mid")), F.lit(1.0))).alias("ratio"))


def repair_straddle(profile: DataFrame, ink: DataFrame, grids: DataFrame, keys: list[str], at: str, value: str, ink_value: str, columns: int, doubtful: float = 1.4, least: float = 1.5, gain: float = 1.3, reach: int = 10) -> DataFrame:
    """keys, origin, pitch, ratio and repaired: a grid whose text straddles its rules gives way to the best one about half a column away.

    profile: keys, at (from 0), value; ink: keys, at, ink_value; grids: keys, origin, pitch (one a group). Only where the text ratio is under
    `doubtful` are pitches within 1.5 (in tenths) and origins within `reach` of half a pitch to either side tried, as far as they lie in the profile; the
    best score (ends twice; first the left side, then the smaller pitch and origin) is taken if its own ratio is above `least` and `gain` times the old one.
    """
    own = text_ratio(ink, grids.select(*keys, F.col("origin").cast("double").alias("origin"), F.col("pitch").cast("double").alias("pitch")), keys, at, ink_value, columns)
    own = session.cut(own)
    width = profile.groupBy(*keys).agg(F.max(at).alias("last_"))
    tenths = F.transform(F.sequence(F.lit(0), F.lit(29)), lambda i: (F.col("pitch") * 10 - 15 + i) / 10)
    tried = own.filter(F.col("ratio") < doubtful).join(width, keys).withColumn("side", F.explode(F.array(F.lit(-0.5), F.lit(0.5)))).withColumn("p2", F.explode(tenths))
    tried = tried.withColumn("o2", F.explode(F.transform(F.sequence(F.lit(0), F.lit(2 * reach - 1)), lambda i: F.col("origin") + F.col("side") * F.col("pitch") - reach + i)))
    tried = tried.filter((F.col("o2") >= 0) & (F.col("o2") + F.col("p2") * columns <= F.col("last_"))).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(columns))))
    spots = tried.select(*keys, "side", "p2", "o2", "k", F.rint(F.col("o2") + F.col("p2") * F.col("k")).cast("long").alias(at))
    weight = F.when(F.col("k").isin(0, columns), 2).otherwise(1)
    scored = spots.join(profile.select(*keys, at, F.col(value).alias("v_")), [*keys, at], "left").groupBy(*keys, "side", "p2", "o2").agg(F.sum(F.coalesce("v_", F.lit(0)) * weight).alias("score"))
    best = scored.groupBy(*keys).agg(F.min(F.struct((-F.col("score")).alias("s"), "side", "p2", "o2")).alias("b")).select(*keys, F.col("b.o2").alias("origin"), F.col("b.p2").alias("pitch"))
    other = text_ratio(ink, best, keys, at, ink_value, columns).select(*keys, F.col("origin").alias("o2"), F.col("pitch").alias("p2"), F.col("ratio").alias("r2"))
    better = F.coalesce(F.col("r2") > F.greatest(F.lit(least), F.col("ratio") * gain), F.lit(False))
    both = own.join(other, keys, "left")
    return both.select(*keys, *[F.when(better, F.col(n)).otherwise(F.col(o)).alias(o) for o, n in (("origin", "o2"), ("pitch", "p2"), ("ratio", "r2"))], better.alias("repaired"))


def nearest_gap(groups: DataFrame, keys: list[str], start: str, end: str, most: Column | int, centre: Column) -> DataFrame:
    """Of consecutive groups less than `most` apart, the pair whose middle is nearest to the centre; the earlier one at ties."""
    w = Window.partitionBy(*keys).orderBy(start)
    pairs = groups.withColumn("next_start", F.lead(start).over(w)).filter(F.col("next_start") - F.col(end) < most)
    middle = F.floor((F.col(end) + F.col("next_start")) / 2)
    best = pairs.groupBy(*keys).agg(F.min(F.struct(F.abs(middle - centre).alias("d"), F.col(end).alias("left"), F.col("next_start").alias("right"))).alias("b"))
    return best.select(*keys, F.col("b.left").alias("left"), F.col("b.right").alias("right"), F.col("b.d").alias("distance"))
