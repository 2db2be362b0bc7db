"""Profiles and fits: hourly counts of events stand in for projection profiles, prices for measured sizes."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessella import session
from tessella.functions import scalars as S
from tessella.operators import fit as P
from tessella.operators import ml
from tessella.session import prepare, table

HOUR = 3_600_000_000


def _profile(spark, sf_dir):
    """Events a type and hour of January 2024, from 0; hours without any are left out."""
    us = S.micros("ts") - 1_704_067_200_000_000
    return table(prepare(spark), sf_dir, "events").groupBy("event_type", F.floor(us / HOUR).alias("h")).agg(F.count("*").alias("n"))


_PROFILE = "SELECT event_type, CAST(floor((epoch_us(ts) - 1704067200000000) / 3600000000) AS BIGINT) AS h, count(*) AS n FROM events GROUP BY ALL"


def outlier_guard(spark, sf_dir):
    li = table(prepare(spark), sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_returnflag", "l_extendedprice")
    out = P.median_guard(li, ["l_returnflag"], "l_extendedprice", 0.9)
    return out.select("l_orderkey", "l_linenumber", "l_returnflag", S.r6(F.col("mid")).alias("mid"))


def contrast_filter(spark, sf_dir):
    li = table(prepare(spark), sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_returnflag", "l_extendedprice")
    return P.contrast(li, ["l_returnflag"], "l_extendedprice", 0.62).select("l_orderkey", "l_linenumber", "l_returnflag")


def smooth_cap(spark, sf_dir):
    return P.smooth_cap(_profile(spark, sf_dir), ["event_type"], "h", "n", 2, 0.75).select("event_type", "h", S.r6(F.col("smoothed")).alias("smoothed"))


def local_argmax(spark, sf_dir):
    return P.snap(_profile(spark, sf_dir), ["event_type"], "h", "n", 4).select("event_type", "h", "peak_at")


def adjacent_pair(spark, sf_dir):
    """Busy hours (3 events or more) as groups; the near pair closest to the middle of the month."""
    busy = _profile(spark, sf_dir).filter("n >= 3").select("event_type", F.col("h").alias("s"), (F.col("h") + 1).alias("e"))
    return P.nearest_gap(busy, ["event_type"], "s", "e", 24, F.lit(360)).select("event_type", "left", "right", "distance")


def trimmed_regression(spark, sf_dir):
    ev = table(prepare(spark), sf_dir, "events").select("event_type", ((S.micros("ts") - 1_704_067_200_000_000) / (24 * HOUR)).alias("day"), "value")
    out = P.trimmed_line(ev, ["event_type"], "day", "value", 60.0)
    return out.select("event_type", F.round("slope", 5).alias("slope"), F.round("intercept", 4).alias("intercept"), "n")


def grid_search(spark, sf_dir):
    out = P.grid_search(_profile(spark, sf_dir), ["event_type"], "h", "n", [23, 24, 25], 9)
    return out.select("event_type", F.col("pitch").cast("long").alias("pitch"), "origin", "score")


def straddle_repair(spark, sf_dir):
    """Grids of eight columns fitted to hours, and what their repair makes of them. A type's strokes are heavy at midnight, and its text is at midday; of views
    and errors the strokes of the text at midday are the heavier ones, so that the grid is half a column off; of errors the text is everywhere, so no grid is better."""
    hour, kind = F.col("h") % 24, F.col("event_type")
    off = kind.isin("view", "error")
    near = lambda x: (F.least(F.abs(hour - x), 24 - F.abs(hour - x)) == 0)
    stroke = F.when(near(0), F.when(off, 15).otherwise(20)).when(near(12), F.when(off, 20).otherwise(2)).otherwise(0)
    ink = F.when(kind == "error", 2).when(hour.between(6, 17), 6).otherwise(1)
    profile = _profile(spark, sf_dir).filter("h >= 0").select("event_type", "h", (F.col("n") * stroke).cast("long").alias("v"), (F.col("n") * ink).cast("long").alias("ink"))
    strokes = profile.filter("v > 0")
    grids = P.grid_search(strokes, ["event_type"], "h", "v", [23, 24, 25], 9).select("event_type", "origin", "pitch")
    with session.scratch(spark):
        out = P.repair_straddle(strokes, profile, grids, ["event_type"], "h", "v", "ink", 8)
        return out.select("event_type", S.r6(F.col("origin")).alias("origin"), S.r6(F.col("pitch")).alias("pitch"), S.r6(F.col("ratio")).alias("ratio"), "repaired").checkpoint(eager=True)


def band_ratio(spark, sf_dir):
    """Events in the inner half of the day over those in the outer half, which count as 1 at least."""
    inner = F.col("h") % 24
    w = F.when(inner.between(6, 17), F.col("n")).otherwise(0)
    return _profile(spark, sf_dir).groupBy("event_type").agg(S.r6(F.sum(w) / F.greatest(F.sum(F.col("n") - w), F.lit(1))).alias("ratio"))


def group_statistics(spark, sf_dir):
    li = table(prepare(spark), sf_dir, "lineitem")
    q = P.quantiles(li, ["l_returnflag"], "l_quantity", mid=0.5, p90=0.9)
    rest = li.groupBy("l_returnflag").agg(F.round(F.stddev_pop("l_quantity"), 5).alias("sd"), F.count_if(F.col("l_quantity") > 25).alias("large"))
    return rest.join(q, "l_returnflag").select("l_returnflag", S.r6(F.col("mid")).alias("mid"), S.r6(F.col("p90")).alias("p90"), "sd", "large")


def largest_gap(spark, sf_dir):
    """For each type the longest stretch between events' hours and where it begins; the first one at ties."""
    w = Window.partitionBy("event_type").orderBy("h")
    g = _profile(spark, sf_dir).withColumn("gap", F.lead("h").over(w) - F.col("h")).filter("gap is not null")
    b = g.groupBy("event_type").agg(F.min(F.struct((-F.col("gap")).alias("k"), "h")).alias("b"))
    return b.select("event_type", (-F.col("b.k")).alias("gap"), F.col("b.h").alias("h"))


def stacked_classifier(spark, sf_dir):
    return ml.stacked_scores(table(prepare(spark), sf_dir, "documents"), table(spark, sf_dir, "labels"))


def cleaned_classifier(spark, sf_dir):
    """The stacked classifier without the positives that models of other folds reject."""
    return ml.cleaned_scores(table(prepare(spark), sf_dir, "documents"), table(spark, sf_dir, "labels"))


def classifier_accuracy(spark, sf_dir):
    """Held-out accuracy of the classifier's first stage by label."""
    return ml.held_out_accuracy(table(prepare(spark), sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (outlier_guard, contrast_filter, smooth_cap, local_argmax, adjacent_pair, trimmed_regression, grid_search, straddle_repair, band_ratio, group_statistics, largest_gap, stacked_classifier, cleaned_classifier, classifier_accuracy)}

_FIT = "SELECT event_type, regr_slope(value, day) AS s, regr_intercept(value, day) AS i, count(*) AS n FROM {} GROUP BY event_type"

_RATIO = """{name} AS (SELECT event_type, origin, pitch, coalesce(sum(ink) FILTER (mid), 0)::DOUBLE / greatest(coalesce(sum(ink) FILTER (NOT mid), 0), 1)::DOUBLE AS ratio FROM (
 SELECT g.event_type, g.origin, g.pitch, p.ink, p.h >= trunc(a + (b - a) / 4) AND p.h < trunc(b - (b - a) / 4) AS mid
 FROM (SELECT *, origin + pitch * k AS a, origin + pitch * (k + 1) AS b FROM {grids}, range(8) t(k)) g LEFT JOIN inked p ON p.event_type = g.event_type AND p.h >= trunc(g.a) AND p.h < trunc(g.b)) GROUP BY ALL)"""
_STRADDLE = f"""WITH p AS ({_PROFILE}),
inked AS (SELECT event_type, h, n * CASE WHEN h % 24 = 0 THEN CASE WHEN event_type IN ('view', 'error') THEN 15 ELSE 20 END WHEN h % 24 = 12 THEN CASE WHEN event_type IN ('view', 'error') THEN 20 ELSE 2 END ELSE 0 END AS v,
 n * CASE WHEN event_type = 'error' THEN 2 WHEN h % 24 BETWEEN 6 AND 17 THEN 6 ELSE 1 END AS ink FROM p WHERE h >= 0),
s AS (SELECT event_type, pitch, h - k * pitch AS origin, sum(v * CASE WHEN k IN (0, 8) THEN 2 ELSE 1 END) AS score FROM inked, (VALUES (23), (24), (25)) a(pitch), range(0, 9) b(k) WHERE v > 0 GROUP BY ALL),
g0 AS (SELECT event_type, pitch::DOUBLE AS pitch, origin::DOUBLE AS origin FROM s QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY score DESC, pitch, origin) = 1),
{_RATIO.format(name="own", grids="g0")},
tried AS (SELECT event_type, side, (pitch * 10 - 15 + i) / 10 AS p2, origin + side * pitch - 10 + j AS o2, w.last FROM own JOIN (SELECT event_type, max(h) AS last FROM inked WHERE v > 0 GROUP BY 1) w USING (event_type), (VALUES (-0.5::DOUBLE), (0.5::DOUBLE)) a(side), range(30) b(i), range(20) c(j) WHERE ratio < 1.4::DOUBLE),
scored AS (SELECT t.event_type, side, p2, o2, sum(coalesce(v, 0) * CASE WHEN k IN (0, 8) THEN 2 ELSE 1 END) AS score FROM (SELECT * FROM tried, range(9) d(k) WHERE o2 >= 0 AND o2 + p2 * 8 <= last) t LEFT JOIN (FROM inked WHERE v > 0) x ON x.event_type = t.event_type AND x.h = CAST(round_even(o2 + p2 * k, 0) AS BIGINT) GROUP BY ALL),
g1 AS (SELECT event_type, o2 AS origin, p2 AS pitch FROM scored QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY score DESC, side, p2, o2) = 1),
{_RATIO.format(name="other", grids="g1")},
j AS (SELECT own.*, other.origin AS o2, other.pitch AS p2, other.ratio AS r2, coalesce(other.ratio > greatest(1.5::DOUBLE, own.ratio * 1.3::DOUBLE), false) AS repaired FROM own LEFT JOIN other USING (event_type))
SELECT event_type, round(CASE WHEN repaired THEN o2 ELSE origin END, 6) AS origin, round(CASE WHEN repaired THEN p2 ELSE pitch END, 6) AS pitch, round(CASE WHEN repaired THEN r2 ELSE ratio END, 6) AS ratio, repaired FROM j"""

ORACLE_SQL = {
    "straddle_repair": _STRADDLE,
    "outlier_guard": "WITH m AS (SELECT l_returnflag, median(l_extendedprice) AS mid FROM lineitem GROUP BY 1) SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_returnflag, round(mid, 6) AS mid FROM lineitem JOIN m USING (l_returnflag) WHERE abs(l_extendedprice - mid) > 0.9::DOUBLE * mid",
    "contrast_filter": "WITH m AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.02) AS p, median(l_extendedprice) AS mid FROM lineitem GROUP BY 1) SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_returnflag FROM lineitem JOIN m USING (l_returnflag) WHERE l_extendedprice <= p + (mid - p) * 0.62::DOUBLE",
    "smooth_cap": f"WITH p AS ({_PROFILE}), s AS (SELECT event_type, h, sum(n) OVER (PARTITION BY event_type ORDER BY h ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS t FROM p) SELECT event_type, h, round(least(t::DOUBLE, 0.75::DOUBLE * max(t) OVER (PARTITION BY event_type)), 6) AS smoothed FROM s",
    "local_argmax": f"WITH p AS ({_PROFILE}), r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY h) AS r FROM p), j AS (SELECT a.event_type, a.h, b.h AS peak_at, row_number() OVER (PARTITION BY a.event_type, a.h ORDER BY b.n DESC, b.h) AS k FROM r a JOIN r b ON a.event_type = b.event_type AND b.r BETWEEN a.r - 4 AND a.r + 4) SELECT event_type, h, peak_at FROM j WHERE k = 1",
    "adjacent_pair": f"WITH b AS (SELECT event_type, h, lead(h) OVER (PARTITION BY event_type ORDER BY h) AS x FROM ({_PROFILE}) WHERE n >= 3), d AS (SELECT event_type, h + 1 AS \"left\", x AS \"right\", abs((h + 1 + x) // 2 - 360) AS distance FROM b WHERE x - h - 1 < 24) SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY distance, \"left\") AS r FROM d) WHERE r = 1",
    "trimmed_regression": f"""WITH e AS (SELECT event_type, (epoch_us(ts) - 1704067200000000) / 86400000000 AS day, value FROM events), f0 AS ({_FIT.format('e')}),
e1 AS (SELECT e.* FROM e JOIN f0 USING (event_type) WHERE abs(value - s * day - i) < 60), g1 AS ({_FIT.format('e1')}), f1 AS (SELECT event_type, CASE WHEN g1.n >= 40 THEN g1.s ELSE f0.s END AS s, CASE WHEN g1.n >= 40 THEN g1.i ELSE f0.i END AS i, CASE WHEN g1.n >= 40 THEN g1.n ELSE f0.n END AS n FROM f0 LEFT JOIN g1 USING (event_type)),
e2 AS (SELECT e1.* FROM e1 JOIN f1 USING (event_type) WHERE abs(value - s * day - i) < 60), g2 AS ({_FIT.format('e2')})
SELECT event_type, round(CASE WHEN g2.n >= 40 THEN g2.s ELSE f1.s END, 5) AS slope, round(CASE WHEN g2.n >= 40 THEN g2.i ELSE f1.i END, 4) AS intercept, CASE WHEN g2.n >= 40 THEN g2.n ELSE f1.n END AS n FROM f1 LEFT JOIN g2 USING (event_type)""",
    "grid_search": f"WITH p AS ({_PROFILE}), s AS (SELECT event_type, pitch, h - k * pitch AS origin, sum(n * CASE WHEN k IN (0, 8) THEN 2 ELSE 1 END) AS score FROM p, (VALUES (23), (24), (25)) a(pitch), range(0, 9) b(k) GROUP BY ALL) SELECT event_type, pitch::BIGINT AS pitch, origin, score::BIGINT AS score FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY score DESC, pitch, origin) AS r FROM s) WHERE r = 1",
    "band_ratio": f"SELECT event_type, round(coalesce(sum(n) FILTER (h % 24 BETWEEN 6 AND 17), 0) / greatest(coalesce(sum(n) FILTER (h % 24 NOT BETWEEN 6 AND 17), 0), 1)::DOUBLE, 6) AS ratio FROM ({_PROFILE}) GROUP BY event_type",
    "group_statistics": "SELECT l_returnflag, round(median(l_quantity), 6) AS mid, round(quantile_cont(l_quantity, 0.9), 6) AS p90, round(stddev_pop(l_quantity), 5) AS sd, count(*) FILTER (l_quantity > 25) AS large FROM lineitem GROUP BY 1",
    "largest_gap": f"WITH g AS (SELECT event_type, h, lead(h) OVER (PARTITION BY event_type ORDER BY h) - h AS gap FROM ({_PROFILE})) SELECT event_type, gap, h FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY gap DESC, h) AS r FROM g WHERE gap IS NOT NULL) WHERE r = 1",
}
