"""Layout queries: an order is a column of a page, its lines are runs from top to bottom; ids of the survey's operators in brackets."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessella.functions import scalars as S
from tessella.operators import intervals as I
from tessella.operators import layout as Y
from tessella.session import prepare, table

SLOT = 20


def _runs(spark, sf_dir):
    """Each line a run: they follow one another, in line order, with a gap of one to seven."""
    l = table(prepare(spark), sf_dir, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    gap, high = F.col("l_partkey") % 7 + 1, (F.col("l_quantity").cast("long") % 30) + 2
    e = F.sum(gap + high).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return l.select("l_orderkey", F.row_number().over(w).cast("long").alias("nth"), (e - high).alias("s"), e.alias("e"), "l_suppkey", "l_partkey")


def _columns(spark, sf_dir):
    return _runs(spark, sf_dir).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("runs"))


_R = """r0 AS (SELECT l_orderkey, l_suppkey, l_partkey, l_quantity::BIGINT % 30 + 2 AS high, sum(l_partkey % 7 + 1 + l_quantity::BIGINT % 30 + 2) OVER w AS e, row_number() OVER w AS nth FROM lineitem
WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity ROWS UNBOUNDED PRECEDING)),
r AS (SELECT l_orderkey, nth, (e - high)::BIGINT AS s, e::BIGINT AS e, l_suppkey, l_partkey FROM r0)"""


def headwords(spark, sf_dir):
    """Headwords of columns [P13]."""
    h = _columns(spark, sf_dir).select("l_orderkey", Y.headword(F.col("runs"), SLOT).alias("h")).filter("h is not null")
    return h.select("l_orderkey", "h.s", "h.e")


def column_kinds(spark, sf_dir):
    """Flat headwords and tallies among columns [P14 P15]."""
    return _columns(spark, sf_dir).select("l_orderkey", Y.flat_headword(F.col("runs"), SLOT).alias("flat"), Y.tally(F.col("runs"), 2).alias("tally"))


def run_windows(spark, sf_dir):
    """Sliding windows over long runs [W10]."""
    return Y.windows(_runs(spark, sf_dir).select("l_orderkey", F.col("s").alias("from"), F.col("e").alias("to")), "from", "to", 8).select("l_orderkey", "from", "s", "e")


def _profile(spark, sf_dir):
    ev = table(prepare(spark), sf_dir, "events").select("event_type", F.floor(S.micros("ts") / 3_600_000_000).alias("h"), "value")
    return ev.groupBy("event_type", "h").agg(F.sum(F.floor("value")).alias("v"))


def projection_profile(spark, sf_dir):
    """Sums of a mask along an axis [G8]: of events, by type and hour."""
    return _profile(spark, sf_dir)


def valley_cuts(spark, sf_dir):
    """Pairs of cuts in the valleys of a profile, two to five hours apart [W11]."""
    return Y.cut_pairs(Y.valleys(_profile(spark, sf_dir), ["event_type"], "h", "v"), ["event_type"], 2, 5)


def strong_ends(spark, sf_dir):
    """The last and the first strong group of each key: of an order's lines those with at least 0.45 of its largest quantity [W9]."""
    l = table(prepare(spark), sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.max("l_quantity").over(Window.partitionBy("l_orderkey")).alias("most"))
    strong = l.filter(F.col("l_quantity") >= 0.45 * F.col("most"))
    return strong.groupBy("l_orderkey").agg(F.max("l_linenumber").cast("long").alias("top"), F.min("l_linenumber").cast("long").alias("bottom"))


def snapped_rules(spark, sf_dir):
    """The place of the largest value within four places, taken only from 0.15 of the height on [W7]."""
    p = _profile(spark, sf_dir)
    w = Window.partitionBy("event_type").orderBy("h").rowsBetween(-4, 4)
    best = F.min(F.struct((-F.col("v")).alias("k"), F.col("h").alias("p"))).over(w)
    high = F.max("v").over(Window.partitionBy("event_type"))
    return p.select("event_type", "h", F.when(-best["k"] >= 0.15 * high, best["p"]).otherwise(F.col("h")).alias("snapped"))


def fold_between(spark, sf_dir):
    """A page's fold: the middle of the narrowest-set pair of groups nearest to the centre, else of a wide group there, else the centre [W8]."""
    r = _runs(spark, sf_dir)
    size = r.groupBy("l_orderkey").agg(F.max("e").alias("height"))
    r = r.join(size, "l_orderkey").withColumn("next", F.lead("s").over(Window.partitionBy("l_orderkey").orderBy("s")))
    centre = F.floor(F.col("height") / 2)
    pair = F.when(F.col("next") - F.col("e") < 0.03 * F.col("height"), F.floor((F.col("e") + F.col("next")) / 2))
    wide = F.when((F.col("e") - F.col("s") > 0.2 * F.col("height")) & F.col("s").between(centre - 20, centre), F.floor((F.col("s") + F.col("e")) / 2))
    nearest = lambda c: F.min(F.when(c.isNotNull(), F.struct(F.abs(c - centre).alias("d"), c.alias("m"))))["m"]
    return r.groupBy("l_orderkey", "height").agg(nearest(pair).alias("a"), nearest(wide).alias("b")).select("l_orderkey", F.coalesce("a", "b", F.floor(F.col("height") / 2)).alias("fold"))


def near_misses(spark, sf_dir):
    """Candidates that stay beside what is taken: lines of even number as candidates, the first line is taken [D2 D3 S2]: scored by their supplier, from 0.15 of the range on."""
    r = _runs(spark, sf_dir).select("l_orderkey", "nth", F.when(F.col("nth") % 3 == 0, F.col("s") - 9).otherwise(F.col("s")).alias("s"), "e", ((F.col("l_suppkey") % 100) / 100).alias("score"))
    cand, taken = r.filter("nth > 1 and score >= 0.15"), r.filter("nth = 1")
    return Y.suppress_seeded(cand, taken, ["l_orderkey"], "score", "nth", 0.25, S.overlap_shorter)


def accepted(spark, sf_dir):
    """Which candidates are accepted by kind: headwords (first lines) from 0.1, others from 0.8, near misses from 0.15; others over a headword by more than a quarter are left out [D3]."""
    r = _runs(spark, sf_dir).select("l_orderkey", "nth", F.when(F.col("nth") % 3 == 0, F.col("s") - 9).otherwise(F.col("s")).alias("s"), "e", ((F.col("l_suppkey") % 100) / 100).alias("score"))
    head = r.filter("nth = 1").select("l_orderkey", F.col("s").alias("hs"), F.col("e").alias("he"))
    j = r.join(head, "l_orderkey").withColumn("over", (F.col("nth") > 1) & (S.overlap_shorter(*map(F.col, ("s", "e", "hs", "he"))) > 0.25))
    state = F.when(F.col("over"), "over").when(F.col("score") >= F.when(F.col("nth") == 1, 0.1).otherwise(0.8), "accepted").when(F.col("score") >= 0.15, "near").otherwise("none")
    return j.select("l_orderkey", "nth", state.alias("state"))


def _scored(spark, sf_dir):
    """Runs as windows, every third one moved up into the one before, scored by their supplier."""
    return _runs(spark, sf_dir).select("l_orderkey", "nth", F.when(F.col("nth") % 3 == 0, F.col("s") - 9).otherwise(F.col("s")).cast("double").alias("s"), F.col("e").cast("double").alias("e"), ((F.col("l_suppkey") % 100) / 100).alias("score"), "l_partkey")


def detections(spark, sf_dir):
    """What is found in each column, from top to bottom, and what nearly was [D1 D2 D3]: the layout's headword from a score of 0.1, windows that do not meet it by more than a
    quarter from 0.8, a flat headword at 0.5 if it is wider than 0.45 of the column; the best of what overlaps; then near misses from 0.15 beside them."""
    x = _scored(spark, sf_dir)
    head = headwords(spark, sf_dir).select("l_orderkey", "s", "e", (F.col("l_orderkey") % 10 / 10).alias("score"))
    first = x.filter("nth = 1").select("l_orderkey", "s", "e", (F.col("l_partkey") % 50).alias("width"))
    flat = column_kinds(spark, sf_dir).filter("flat").select("l_orderkey").join(first.filter("width > 0.45 * 50"), "l_orderkey").select("l_orderkey", "s", "e", F.lit(0.5).alias("score"))
    meets = S.overlap_shorter(*map(F.col, ("s", "e", "hs", "he"))) > 0.25
    free = x.join(head.select("l_orderkey", F.col("s").alias("hs"), F.col("e").alias("he")), "l_orderkey", "left").filter(F.col("hs").isNull() | ~meets).select("l_orderkey", "s", "e", "score", (F.col("nth") + 1).alias("id"))
    sure = head.filter("score >= 0.1").withColumn("id", F.lit(0).cast("long")).unionByName(flat.withColumn("id", F.lit(1).cast("long"))).unionByName(free.filter("score >= 0.8"))
    taken = I.suppress(sure, ["l_orderkey"], "s", "e", "score", "id", 0.25)
    near = Y.suppress_seeded(free.filter("score >= 0.15 and score < 0.8"), taken.select("l_orderkey", "s", "e"), ["l_orderkey"], "score", "id", 0.25, S.overlap_shorter)
    w = Window.partitionBy("l_orderkey").orderBy("s", "e", "id")
    out = taken.withColumn("ord", F.row_number().over(w).cast("long")).unionByName(near.withColumn("ord", F.lit(None).cast("long")).select("l_orderkey", "id", "s", "e", "score", "ord"))
    kind = F.when(F.col("ord").isNull(), "near").when(F.col("id") < 2, "headword").otherwise("inline")
    return out.select("l_orderkey", "s", "e", S.r6(F.col("score")).alias("score"), kind.alias("kind"), "ord")


def training_labels(spark, sf_dir):
    """Windows with labels and where these come from [M4 U1 J9 J21]: in verified columns those that are like a known place (IoU from 0.8 on) or unlike all (to 0.3); in other columns
    with a headword that one, and windows up to 6.2 slots that do not meet it by more than half; and small print of nine tenths of a slot or more wherever it is."""
    x, known = _scored(spark, sf_dir), F.col("l_orderkey") % 10 == 3
    places = _runs(spark, sf_dir).filter(known & (F.col("nth") % 2 == 1)).select("l_orderkey", "s", "e")
    verified = I.iou_label(x.filter(known), places, ["l_orderkey"], "nth", SLOT).select("l_orderkey", "nth", "label", F.lit("verified").alias("source"))
    head = headwords(spark, sf_dir).filter(~known)
    heads = head.select("l_orderkey", F.lit(0).cast("long").alias("nth"), F.lit(1).cast("long").alias("label"), F.lit("layout").alias("source"))
    below = x.filter(F.col("e") <= 6.2 * SLOT).join(head.select("l_orderkey", F.col("s").alias("hs"), F.col("e").alias("he")), "l_orderkey").filter(S.overlap_shorter(*map(F.col, ("s", "e", "hs", "he"))) <= 0.5)
    no = lambda df, source: df.select("l_orderkey", "nth", F.lit(0).cast("long").alias("label"), F.lit(source).alias("source"))
    small = x.filter((F.col("e") - F.col("s") >= 0.9 * SLOT) & (F.col("l_partkey") % 5 == 0))
    return verified.unionByName(heads).unionByName(no(below, "layout")).unionByName(no(small, "small print"))


def box_columns(spark, sf_dir):
    """The column of a page, counted from the right, that holds a box's centre [P17]."""
    rules = F.array(*[F.lit(x) for x in (3, 10, 20, 28, 41)])
    l = table(prepare(spark), sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", (F.col("l_partkey") % 50).alias("x"))
    return l.select("l_orderkey", "l_partkey", "l_suppkey", Y.column_of(F.col("x"), rules).alias("col"))


def view_boxes(spark, sf_dir):
    """View windows, drawn boxes and clamped crops of parts as boxes [P23 P24 P22]."""
    k, s = F.col("p_partkey"), F.col("p_size").cast("long")
    p = table(prepare(spark), sf_dir, "part").select("p_partkey", (k * 7 % 900).alias("x"), (k * 11 % 700).alias("y"), s.alias("w"), (s + k % 5).alias("h"))
    x, y, w, h = map(F.col, "xywh")
    v, d, c = Y.view_window(x, y, w, h), Y.drawn_box(x, y, x + (w % 7) - 3, y - h), Y.clamped_crop(x, y, w, h, F.lit(800).cast("long"), F.lit(600).cast("long"), 8, 50)
    bounds = F.when((x + w > 800) | (y + h > 600), "outside").when(w * h < 10, "empty").otherwise("ok")
    return p.select("p_partkey", *[v[c2].alias(f"v{c2}") for c2 in "xywh"], *[d[c2].alias(f"d{c2}") for c2 in "xywh"], c["x0"].alias("cx0"), c["y1"].alias("cy1"), c["scale"].alias("scale"), bounds.alias("bounds"))


def ink_boxes(spark, sf_dir):
    """Tight boxes of the cells with ink: of orders as grids of line number and supplier digit, ink where the flag is R [I8]."""
    l = table(prepare(spark), sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("x"), (F.col("l_suppkey") % 10).alias("y"), "l_returnflag")
    return Y.tight_box(l, ["l_orderkey"], "x", "y", F.col("l_returnflag") == "R")


def reading_order(spark, sf_dir):
    """Columns, their seals and tally marks in one order a customer (a block): a marker, then seals from the top, then the tally; orders of status P belong to another block [U6]."""
    runs = _runs(spark, sf_dir)
    o = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").select("o_custkey", F.col("o_orderkey").alias("l_orderkey"))
    none = F.lit(None).cast("long").alias("y0")
    seals = runs.join(o, "l_orderkey").select("o_custkey", "l_orderkey", F.lit("seal").alias("kind"), F.col("s").alias("y0"))
    tally = _columns(spark, sf_dir).filter(Y.tally(F.col("runs"), 2)).join(o, "l_orderkey").select("o_custkey", "l_orderkey", F.lit("tally").alias("kind"), none)
    return Y.merged([(0, o.select("o_custkey", "l_orderkey", F.lit("column").alias("kind"), none)), (1, seals), (2, tally)], ["o_custkey"], ["l_orderkey", "y0"])


def labelled_union(spark, sf_dir):
    """Labels from three sources with their provenance, counted: verified columns first, layout rules for the rest, and small print [U1 M4 J21 P25]."""
    heads = headwords(spark, sf_dir).select("l_orderkey", F.lit(1).alias("label"))
    verified = table(spark, sf_dir, "orders").filter("o_orderkey % 10 = 3").select(F.col("o_orderkey").alias("l_orderkey"), F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"))
    small = _runs(spark, sf_dir).groupBy("l_orderkey").agg(F.max(F.col("e") - F.col("s")).alias("most")).filter("most < 12").select("l_orderkey", F.lit(0).alias("label"))
    layout = heads.join(verified, "l_orderkey", "left_anti").withColumn("source", F.lit("layout"))
    both = verified.withColumn("source", F.lit("verified")).unionByName(layout)
    out = both.unionByName(small.join(both, "l_orderkey", "left_anti").withColumn("source", F.lit("small print")))
    return out.groupBy("source", "label").agg(F.count("*").alias("n")).withColumn("label", F.col("label").cast("long"))


QUERIES = {f.__name__: f for f in (
    headwords, column_kinds, run_windows, projection_profile, valley_cuts, strong_ends, snapped_rules, fold_between, near_misses, accepted, detections, training_labels, box_columns, view_boxes, ink_boxes, reading_order, labelled_union,
)}

_PROFILE = "p AS (SELECT event_type, CAST(floor(epoch_us(ts) / 3600000000) AS BIGINT) AS h, sum(floor(value))::BIGINT AS v FROM events GROUP BY ALL)"
_HEADS = f"h AS (SELECT l_orderkey, min_by(s, s) AS s, min_by(e, s) AS e1, max(CASE WHEN e <= {2.12 * SLOT}::DOUBLE THEN e END) AS e2 FROM r GROUP BY l_orderkey), h2 AS (SELECT l_orderkey, s, greatest(e1, coalesce(e2, e1)) AS e FROM h), heads AS (SELECT l_orderkey, s::DOUBLE AS s, CASE WHEN e - s > {2.25 * SLOT} THEN s + {2 * SLOT} ELSE e END::DOUBLE AS e FROM h2 WHERE s <= {0.45 * SLOT} AND e - s >= {1.2 * SLOT})"
_OVER = "greatest(least({0}.e, {1}.e) - greatest({0}.s, {1}.s), 0)::DOUBLE / greatest(least({0}.e - {0}.s, {1}.e - {1}.s), 1)"
_SCORED = "x AS (SELECT l_orderkey, nth, CASE WHEN nth % 3 = 0 THEN s - 9 ELSE s END AS s, e, (l_suppkey % 100)::DOUBLE / 100 AS score FROM r)"
_TALLY = "t AS (SELECT l_orderkey, min_by(s, s) >= 5 AND count(*) >= 2 AS tally FROM r GROUP BY l_orderkey)"

_KIND = f"a AS (SELECT l_orderkey, list(s ORDER BY s) AS s, list(e ORDER BY s) AS e FROM r GROUP BY l_orderkey), flats AS (SELECT l_orderkey FROM a WHERE coalesce(e[1] - s[1] < {0.35 * SLOT} AND (s[1] + e[1]) / 2.0 BETWEEN {0.6 * SLOT} AND {1.25 * SLOT} AND s[2] >= {1.8 * SLOT}, false))"
_WINDOWS = "x AS (SELECT l_orderkey, nth, (CASE WHEN nth % 3 = 0 THEN s - 9 ELSE s END)::DOUBLE AS s, e::DOUBLE AS e, (l_suppkey % 100)::DOUBLE / 100 AS score, l_partkey FROM r)"

ORACLE_SQL = {
    "detections": f"""WITH RECURSIVE {_R}, {_HEADS}, {_KIND}, {_WINDOWS},
free AS (SELECT x.l_orderkey, x.s, x.e, x.score, x.nth + 1 AS id FROM x LEFT JOIN heads h ON h.l_orderkey = x.l_orderkey WHERE h.s IS NULL OR {_OVER.format('x', 'h')} <= 0.25),
c0 AS (SELECT 0 AS late, l_orderkey, s, e, l_orderkey % 10 / 10 AS score, 0::BIGINT AS id FROM heads WHERE l_orderkey % 10 / 10 >= 0.1::DOUBLE
 UNION ALL SELECT 0, x.l_orderkey, x.s, x.e, 0.5, 1 FROM x JOIN flats USING (l_orderkey) WHERE nth = 1 AND l_partkey % 50 > 22.5
 UNION ALL SELECT CASE WHEN score >= 0.8::DOUBLE THEN 0 ELSE 1 END, l_orderkey, s, e, score, id FROM free WHERE score >= 0.15::DOUBLE),
c AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY late, score DESC, id) AS k FROM c0),
st AS (SELECT l_orderkey, 0::BIGINT AS k, []::STRUCT(s DOUBLE, e DOUBLE)[] AS seen, 0 AS late, 0::BIGINT AS id, 0::DOUBLE AS s, 0::DOUBLE AS e, 0::DOUBLE AS score, false AS ok FROM (SELECT DISTINCT l_orderkey FROM c)
UNION ALL SELECT l_orderkey, k, CASE WHEN ok THEN list_append(seen, {{'s': s, 'e': e}}) ELSE seen END, late, id, s, e, score, ok FROM (SELECT st.l_orderkey, c.k, st.seen, c.late, c.id, c.s, c.e, c.score, len(list_filter(st.seen, lambda q: {_OVER.format('c', 'q')} > 0.25)) = 0 AS ok FROM st JOIN c ON c.l_orderkey = st.l_orderkey AND c.k = st.k + 1))
SELECT l_orderkey, s, e, round(score, 6) AS score, CASE WHEN late = 1 THEN 'near' WHEN id < 2 THEN 'headword' ELSE 'inline' END AS kind, CASE WHEN late = 0 THEN row_number() OVER (PARTITION BY l_orderkey, late ORDER BY s, e, id) END AS ord FROM st WHERE ok""",
    "training_labels": f"""WITH {_R}, {_HEADS}, {_WINDOWS},
v AS (SELECT x.l_orderkey, x.nth, max(coalesce(greatest(least(x.e, k.e) - greatest(x.s, k.s), 0)::DOUBLE / greatest(x.e - x.s + k.e - k.s - greatest(least(x.e, k.e) - greatest(x.s, k.s), 0), 1), 0)) AS iou
 FROM x LEFT JOIN r k ON k.l_orderkey = x.l_orderkey AND k.nth % 2 = 1 WHERE x.l_orderkey % 10 = 3 GROUP BY ALL),
mine AS (SELECT * FROM heads WHERE l_orderkey % 10 <> 3)
SELECT l_orderkey, nth, CASE WHEN iou >= 0.8::DOUBLE THEN 1 ELSE 0 END::BIGINT AS label, 'verified' AS source FROM v WHERE iou >= 0.8::DOUBLE OR iou <= 0.3::DOUBLE
UNION ALL SELECT l_orderkey, 0, 1, 'layout' FROM mine UNION ALL SELECT x.l_orderkey, x.nth, 0, 'layout' FROM x JOIN mine ON mine.l_orderkey = x.l_orderkey WHERE x.e <= {6.2 * SLOT}::DOUBLE AND {_OVER.format("x", "mine")} <= 0.5
UNION ALL SELECT l_orderkey, nth, 0, 'small print' FROM x WHERE e - s >= {0.9 * SLOT}::DOUBLE AND l_partkey % 5 = 0""",
    "headwords": f"WITH {_R}, {_HEADS} SELECT * FROM heads",
    "column_kinds": f"""WITH {_R}, a AS (SELECT l_orderkey, list(s ORDER BY s) AS s, list(e ORDER BY s) AS e FROM r GROUP BY l_orderkey)
SELECT l_orderkey, coalesce(e[1] - s[1] < {0.35 * SLOT} AND (s[1] + e[1]) / 2.0 BETWEEN {0.6 * SLOT} AND {1.25 * SLOT} AND s[2] >= {1.8 * SLOT}, false) AS flat, len(s) >= 2 AND s[1] >= 5 AS tally FROM a""",
    "run_windows": f"WITH {_R}, x AS (SELECT l_orderkey, s AS f, unnest(range(s, e - 16 + 1, 2)) AS s FROM r WHERE e - s >= 16) SELECT l_orderkey, f AS \"from\", s, s + 16 AS e FROM x",
    "projection_profile": f"WITH {_PROFILE} SELECT * FROM p",
    "valley_cuts": f"""WITH {_PROFILE}, m AS (SELECT event_type, greatest(2.0, 0.3::DOUBLE * median(v)) AS most FROM p GROUP BY 1), l AS (SELECT p.event_type, h, h - row_number() OVER (PARTITION BY p.event_type ORDER BY h) AS g FROM p JOIN m ON m.event_type = p.event_type AND v <= most),
c AS (SELECT event_type, CAST(floor((min(h) + max(h)) / 2.0) AS BIGINT) AS cut FROM l GROUP BY event_type, g) SELECT a.event_type, a.cut AS s, b.cut AS e FROM c a JOIN c b ON a.event_type = b.event_type AND b.cut - a.cut BETWEEN 2 AND 5""",
    "strong_ends": "WITH l AS (SELECT *, max(l_quantity) OVER (PARTITION BY l_orderkey) AS most FROM lineitem) SELECT l_orderkey, max(l_linenumber)::BIGINT AS top, min(l_linenumber)::BIGINT AS bottom FROM l WHERE l_quantity >= 0.45::DOUBLE * most GROUP BY l_orderkey",
    "snapped_rules": f"""WITH {_PROFILE}, q AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY h) AS n, max(v) OVER (PARTITION BY event_type) AS high FROM p),
b AS (SELECT a.event_type, a.h, a.high, arg_min(c.h, (-c.v, c.h)) AS p, max(c.v) AS v FROM q a JOIN q c ON a.event_type = c.event_type AND c.n BETWEEN a.n - 4 AND a.n + 4 GROUP BY ALL)
SELECT event_type, h, CASE WHEN v >= 0.15::DOUBLE * high THEN p ELSE h END AS snapped FROM b""",
    "fold_between": f"""WITH {_R}, x AS (SELECT *, max(e) OVER (PARTITION BY l_orderkey) AS height, lead(s) OVER (PARTITION BY l_orderkey ORDER BY s) AS nx FROM r),
y AS (SELECT l_orderkey, height, height // 2 AS c, CASE WHEN nx - e < 0.03::DOUBLE * height THEN (e + nx) // 2 END AS a, CASE WHEN e - s > 0.2::DOUBLE * height AND s BETWEEN height // 2 - 20 AND height // 2 THEN (s + e) // 2 END AS b FROM x)
SELECT l_orderkey, coalesce(arg_min(a, (abs(a - c), a)) FILTER (a IS NOT NULL), arg_min(b, (abs(b - c), b)) FILTER (b IS NOT NULL), any_value(c))::BIGINT AS fold FROM y GROUP BY l_orderkey""",
    "near_misses": f"""WITH RECURSIVE {_R}, {_SCORED}, c AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, nth) AS k FROM x WHERE nth > 1 AND score >= 0.15),
st AS (SELECT l_orderkey, 0::BIGINT AS k, [{{'s': s, 'e': e}}] AS seen, 0::BIGINT AS nth, 0::BIGINT AS s, 0::BIGINT AS e, 0::DOUBLE AS score, false AS ok FROM x WHERE nth = 1
UNION ALL SELECT l_orderkey, k, CASE WHEN ok THEN list_append(seen, {{'s': s, 'e': e}}) ELSE seen END, nth, s, e, score, ok FROM (SELECT st.l_orderkey, c.k, st.seen, c.nth, c.s, c.e, c.score, len(list_filter(st.seen, lambda q: {_OVER.format('c', 'q')} > 0.25)) = 0 AS ok FROM st JOIN c ON c.l_orderkey = st.l_orderkey AND c.k = st.k + 1))
SELECT l_orderkey, nth, s, e, score FROM st WHERE ok""",
    "accepted": f"""WITH {_R}, {_SCORED}, h AS (SELECT l_orderkey, s, e FROM x WHERE nth = 1)
SELECT x.l_orderkey, nth, CASE WHEN nth > 1 AND {_OVER.format('x', 'h')} > 0.25 THEN 'over' WHEN score >= CASE WHEN nth = 1 THEN 0.1::DOUBLE ELSE 0.8::DOUBLE END THEN 'accepted' WHEN score >= 0.15::DOUBLE THEN 'near' ELSE 'none' END AS state FROM x JOIN h ON h.l_orderkey = x.l_orderkey""",
    "box_columns": "SELECT l_orderkey, l_partkey, l_suppkey, CASE WHEN x >= 3 AND x < 10 THEN 3 WHEN x >= 10 AND x < 20 THEN 2 WHEN x >= 20 AND x < 28 THEN 1 WHEN x >= 28 AND x < 41 THEN 0 END::BIGINT AS col FROM (SELECT *, l_partkey % 50 AS x FROM lineitem)",
    "view_boxes": """WITH p AS (SELECT p_partkey, p_partkey * 7 % 900 AS x, p_partkey * 11 % 700 AS y, p_size::BIGINT AS w, p_size::BIGINT + p_partkey % 5 AS h FROM part), c AS (SELECT *, greatest(x - 8, 0) AS x0, greatest(y - 8, 0) AS y0, least(x + w + 8, 800) AS x1, least(y + h + 8, 600) AS y1 FROM p)
SELECT p_partkey, greatest(x - 110, 0) AS vx, greatest(y - 130, 0) AS vy, x + w + 110 - greatest(x - 110, 0) AS vw, y + h + 130 - greatest(y - 130, 0) AS vh, least(x, x + w % 7 - 3) AS dx, y - h AS dy, greatest(abs(w % 7 - 3), 2) AS dw, greatest(h, 2) AS dh,
CASE WHEN x1 > x0 AND y1 > y0 THEN x0 END AS cx0, CASE WHEN x1 > x0 AND y1 > y0 THEN y1 END AS cy1, CASE WHEN x1 > x0 AND y1 > y0 THEN round(least(1.0::DOUBLE, 50::DOUBLE / greatest(x1 - x0, y1 - y0)), 6) END AS scale, CASE WHEN x + w > 800 OR y + h > 600 THEN 'outside' WHEN w * h < 10 THEN 'empty' ELSE 'ok' END AS bounds FROM c""",
    "ink_boxes": "SELECT l_orderkey, min(l_linenumber)::BIGINT AS x0, min(l_suppkey % 10) AS y0, max(l_linenumber)::BIGINT + 1 AS x1, max(l_suppkey % 10) + 1 AS y1 FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey",
    "reading_order": f"""WITH {_R}, {_TALLY}, o AS (SELECT o_custkey, o_orderkey AS l_orderkey FROM orders WHERE o_orderstatus <> 'P'), u AS (SELECT *, 'column' AS kind, NULL::BIGINT AS y0, 0 AS k FROM o UNION ALL SELECT o.*, 'seal', s, 1 FROM o JOIN r ON r.l_orderkey = o.l_orderkey UNION ALL SELECT o.*, 'tally', NULL, 2 FROM o JOIN t ON t.l_orderkey = o.l_orderkey WHERE tally)
SELECT o_custkey, l_orderkey, kind, y0, row_number() OVER (PARTITION BY o_custkey ORDER BY l_orderkey, k, y0) AS ord FROM u""",
    "labelled_union": f"""WITH {_R}, {_HEADS}, v AS (SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label FROM orders WHERE o_orderkey % 10 = 3), l AS (SELECT l_orderkey AS k FROM heads WHERE l_orderkey NOT IN (SELECT k FROM v)),
s AS (SELECT l_orderkey AS k FROM r GROUP BY 1 HAVING max(e - s) < 12 AND l_orderkey NOT IN (SELECT k FROM v) AND l_orderkey NOT IN (SELECT k FROM l)), u AS (SELECT 'verified' AS source, label FROM v UNION ALL SELECT 'layout', 1 FROM l UNION ALL SELECT 'small print', 0 FROM s)
SELECT source, label::BIGINT AS label, count(*) AS n FROM u GROUP BY ALL""",
}
