"""Runs, intervals, boxes and sequences: queries over events, orders and line items that stand in for detections."""

from pyspark.sql import functions as F

from tessella.functions import scalars as S
from tessella.operators import alignment as A
from tessella.operators import components as C
from tessella.operators import intervals as I
from tessella.operators import recovery as R
from tessella.session import prepare, table

HOUR = 3_600_000_000


def _events(spark, sf_dir, *columns):
    return table(prepare(spark), sf_dir, "events").select("event_id", "user_id", *columns, S.micros("ts").alias("us"))


def _spans(spark, sf_dir, *columns):
    """Events as intervals: from their time on for `value` hours."""
    return _events(spark, sf_dir, "value", *columns).withColumn("s", F.col("us")).withColumn("e", F.col("us") + F.floor(F.col("value") * HOUR))


_SPANS = "SELECT event_id, user_id, event_type, value, epoch_us(ts) AS s, epoch_us(ts) + CAST(floor(value * 3600000000) AS BIGINT) AS e FROM events"


def islands_gap(spark, sf_dir):
    return I.islands(_events(spark, sf_dir, "value"), ["user_id"], ["us", "event_id"], "us", 6 * HOUR, F.min("us").alias("start_us"), F.max("us").alias("end_us"), F.max("value").alias("peak"), F.count("*").alias("n"))


_ISLANDS = """WITH e AS (SELECT user_id, event_id, epoch_us(ts) AS us, value FROM events),
f AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) > 21600000000 THEN 1 ELSE 0 END AS b FROM e),
g AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS i FROM f),
islands AS (SELECT user_id, min(us) AS start_us, max(us) AS end_us, max(value) AS peak, count(*) AS n FROM g GROUP BY user_id, i)"""


def islands_threshold(spark, sf_dir):
    hours = _events(spark, sf_dir, "event_type").groupBy("event_type", F.floor(F.col("us") / HOUR).alias("h")).agg(F.count("*").alias("n")).filter("n >= 2")
    return I.true_runs(hours, ["event_type"], "h", 2, 3)


def nms_greedy(spark, sf_dir):
    return I.suppress(_spans(spark, sf_dir), ["user_id"], "s", "e", "value", "event_id", 0.25)


def nms_rounds(spark, sf_dir):
    """nms_greedy by rounds of local maxima."""
    return I.suppress_rounds(_spans(spark, sf_dir), ["user_id"], "s", "e", "value", "event_id", 0.25)


def cell_components(spark, sf_dir):
    """Each user's events as cells of a page, a day a row and an hour a column: areas and boxes of their components."""
    hour = F.floor(F.col("us") / HOUR)
    cells = _events(spark, sf_dir).select("user_id", (hour % 24).alias("x"), F.floor(hour / 24).alias("y"))
    return C.cell_components(cells, ["user_id"], "x", "y")


def interval_overlap_pairs(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("event_id")
    df = _spans(spark, sf_dir).select("user_id", "event_id", "s", "e", *[F.lead(c).over(w).alias(f"n_{c}") for c in ("event_id", "s", "e")]).filter("n_event_id is not null")
    return df.select("user_id", "event_id", F.col("n_event_id").alias("next_id"), S.r6(S.overlap_shorter(*map(F.col, ("s", "e", "n_s", "n_e")))).alias("overlap"))


def interval_iou_label(spark, sf_dir):
    df = _spans(spark, sf_dir, "event_type")
    out = I.iou_label(df.filter("event_type = 'click'"), df.filter("event_type = 'purchase'"), ["user_id"], "event_id", 168 * HOUR, 0.5, 0.3)
    return out.select("user_id", "event_id", "label", S.r6(F.col("iou")).alias("iou"))


def box_iou_pairs(spark, sf_dir):
    box = table(prepare(spark), sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 50).alias("x0"), (F.col("l_suppkey") % 10).alias("y0"), F.col("l_quantity").cast("long").alias("w"), (F.col("l_linenumber") * 5).cast("long").alias("h"))
    box = box.select("l_orderkey", "l_linenumber", "x0", "y0", (F.col("x0") + F.col("w")).alias("x1"), (F.col("y0") + F.col("h")).alias("y1"))
    a, b = (box.select("l_orderkey", *[F.col(c).alias(f"{p}{c}") for c in ("l_linenumber", "x0", "y0", "x1", "y1")]) for p in ("a_", "b_"))
    pairs = a.join(b, "l_orderkey").filter("a_l_linenumber < b_l_linenumber").withColumn("iou", S.box_iou("a_", "b_"))
    return pairs.filter("iou > 0.3").select("l_orderkey", F.col("a_l_linenumber").cast("long").alias("line_a"), F.col("b_l_linenumber").cast("long").alias("line_b"), S.r6(F.col("iou")).alias("iou"))


def run_pairs_bounded(spark, sf_dir):
    runs = islands_gap(spark, sf_dir).select("user_id", F.col("start_us").alias("s"), F.col("end_us").alias("e"))
    return I.run_pairs(runs, ["user_id"], int(1.2 * 24 * HOUR), int(2.25 * 24 * HOUR), int(0.9 * 24 * HOUR))


def _typed(spark, sf_dir):
    """The event types of each user, in order."""
    from pyspark.sql import Window

    df = _events(spark, sf_dir, "event_type").withColumn("r", F.row_number().over(Window.partitionBy("user_id").orderBy("us", "event_id")))
    return df.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "event_type"))), lambda x: x["event_type"]).alias("a"))


def _paired(spark, sf_dir):
    """Each user's sequence with the next id's."""
    df = _typed(spark, sf_dir)
    return df.join(df.select((F.col("user_id") - 1).alias("user_id"), F.col("a").alias("b")), "user_id")


_PAIRED = """WITH RECURSIVE e AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events),
t AS (SELECT user_id, list(event_type ORDER BY r) AS a FROM e GROUP BY user_id),
p AS (SELECT x.user_id, x.a, y.a AS b FROM t x JOIN t y ON y.user_id = x.user_id + 1)"""


def align_score(spark, sf_dir):
    """Score of the global alignment of each user's events with the next id's."""
    return A.align_whole(_paired(spark, sf_dir), "user_id").select("user_id", S.r6(F.col("twentieths") / 20).alias("score"))


def align_forced(spark, sf_dir):
    """The first purchases of both are forced together: their row and column lose 5, their cell gains 5."""
    fa, fb = ((F.array_position(c, "purchase") - 1).cast("int").alias(f"f{c}") for c in ("a", "b"))
    return A.align_whole(_paired(spark, sf_dir).select("*", fa, fb), "user_id").select("user_id", S.r6(F.col("twentieths") / 20).alias("score"))


def align_path(spark, sf_dir):
    """The paired places, by anti-diagonals of whole tables; align_path_whole keeps a block of rows at a time."""
    return A.align_paths(_paired(spark, sf_dir), "user_id")


def align_path_whole(spark, sf_dir):
    return A.align_whole(_paired(spark, sf_dir), "user_id", paths=True)


def _anchored(spark, sf_dir):
    """Each user's whole sequence with the next id's; every third purchase and signup (by event id) is assigned a place of the other one, whole value by
    whole value, and errors may not be paired with the place that their value names. Values beyond the other sequence assign nothing."""
    from pyspark.sql import Window

    df = _events(spark, sf_dir, "event_type", "value").withColumn("r", F.row_number().over(Window.partitionBy("user_id").orderBy("us", "event_id")))
    at, to = (F.col("r") - 1).cast("long"), F.floor(F.col("value") / 3).cast("long")
    cell = F.struct(at.alias("i"), to.alias("j"))
    anchor = F.col("event_type").isin("purchase", "signup") & (F.col("event_id") % 3 == 0)
    whole = df.groupBy("user_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("r", "event_type"))), lambda x: x["event_type"]).alias("a"),
        F.array_sort(F.collect_list(F.when(anchor, cell))).alias("forced"),
        F.array_sort(F.collect_list(F.when(F.col("event_type") == "error", cell))).alias("forbidden"),
    )
    known = lambda c: F.filter(c, lambda x: x["j"] < F.size("b")).alias(c)
    return whole.join(whole.select((F.col("user_id") - 1).alias("user_id"), F.col("a").alias("b")), "user_id").select("user_id", "a", "b", known("forced"), known("forbidden"))


def align_anchored(spark, sf_dir):
    """Alignment under many forced pairs, conflicts by order, and forbidden cells."""
    return A.align_whole(_anchored(spark, sf_dir), "user_id").select("user_id", S.r6(F.col("twentieths") / 20).alias("score"))


def align_anchored_path(spark, sf_dir):
    return A.align_whole(_anchored(spark, sf_dir), "user_id", paths=True)


def marker_partition(spark, sf_dir):
    from pyspark.sql import Window

    df = _events(spark, sf_dir, "event_type").withColumn("seen", (F.row_number().over(Window.partitionBy("user_id").orderBy("us", "event_id")) - 1).cast("long"))
    marks = df.groupBy("user_id").agg(F.array_sort(F.collect_list(F.when(F.col("event_type") == "signup", F.col("seen")))).alias("markers"), F.count("*").alias("total"))
    out = A.marker_partition(marks, "user_id", 3).filter("cost is not null")
    return out.select("user_id", *[F.element_at("chosen", k).alias(f"m{k}") for k in (1, 2, 3)], "cost")


def _wanted(spark, sf_dir):
    """Each user's events in order as wanted items: errors are missing, the others paired with a place (three-day columns, rows by the hour); views of little
    similarity are doubtful. Candidates of an item are the places of the events up to four before and behind it, as similar as their ids say."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("us", "event_id")
    e = _events(spark, sf_dir, "event_type", "value").withColumn("j", F.row_number().over(w).cast("long"))
    hour = F.floor((F.col("us") - 1_704_067_200_000_000) / HOUR)
    e = e.select("user_id", "event_id", "event_type", "j", F.floor(hour / 72).alias("pos"), (hour % 72 * 10).alias("y0"), (hour % 72 * 10 + 8).alias("y1"), (F.col("event_id") % 97 / 100).alias("sim"))
    pairs = e.filter("event_type <> 'error'").withColumn("doubtful", (F.col("event_type") == "view") & (F.round("sim", 4) < 0.65))
    near = e.select("user_id", F.col("event_id").alias("c"), F.explode(F.sequence(F.col("j") - 4, F.col("j") + 4)).alias("j"), "pos", (F.col("y0") + F.col("event_id") % 3).alias("y0"), (F.col("y1") + F.col("event_id") % 3).alias("y1"))
    candidates = near.join(e.select("user_id", "j", "event_id"), ["user_id", "j"]).select("user_id", "j", "pos", "y0", "y1", ((F.col("event_id") * 31 + F.col("c") * 17) % 100 / 100).alias("sim"))
    return pairs, e.filter("event_type = 'error'").select("user_id", "j"), candidates


def search_replace(spark, sf_dir):
    """Doubtful pairs and the better places that were found for them between their neighbours."""
    pairs, _, candidates = _wanted(spark, sf_dir)
    return R.replaced(pairs, candidates, ["user_id"], 0, 720, 20).withColumn("sim", S.r6(F.col("sim")))


def search_recover(spark, sf_dir):
    """Places found for missing items between the pairs as the first search left them."""
    pairs, missing, candidates = _wanted(spark, sf_dir)
    out = R.recovered(missing, R.replaced(pairs, candidates, ["user_id"], 0, 720, 20), candidates, ["user_id"], 0, 720, 20)
    return out.withColumn("sim", S.r6(F.col("sim")))


def neighbour_fill(spark, sf_dir):
    df = _events(spark, sf_dir, "event_type")
    return A.neighbours(df, ["user_id"], ["us", "event_id"], F.when(F.col("event_type") == "purchase", F.col("event_id"))).select("event_id", "user_id", "before", "after")


def sandwich_promote(spark, sf_dir):
    orders = table(prepare(spark), sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    weak = (F.col("o_orderstatus") == "O") & (F.col("o_totalprice") >= 50000)
    df = A.promote(orders, ["o_custkey"], ["o_orderkey"], weak, F.col("o_orderstatus") != "O")
    return df.select("o_orderkey", F.when(F.col("promoted"), "aligned").when(F.col("o_orderstatus") == "O", "inferred").otherwise("anchored").alias("status"))


QUERIES = {f.__name__: f for f in (islands_gap, islands_threshold, nms_greedy, nms_rounds, cell_components, interval_overlap_pairs, interval_iou_label, box_iou_pairs, run_pairs_bounded, align_score, align_forced, align_path, align_path_whole, align_anchored, align_anchored_path, marker_partition, search_replace, search_recover, neighbour_fill, sandwich_promote)}
QUERIES |= {"align_score_whole": align_score, "align_forced_whole": align_forced}  # their earlier names, when the others took the first events only

# the table of an alignment a row at a time, in twentieths: level with the steps to the right, a row is a running maximum; `gain` is of row i and column j
_ROWS = """,
tab AS (SELECT user_id, 0 AS i, list_transform(range(len(b) + 1), lambda j: -j) AS cur, []::BIGINT[] AS pairs, []::BIGINT[] AS prev FROM q
UNION ALL
SELECT user_id, i, list_transform(range(m + 1), lambda j: list_max(level[1:j + 1]) - j), pairs, cur FROM (
 SELECT *, list_transform(range(m + 1), lambda j: CASE WHEN j = 0 THEN cur[1] - 1 ELSE greatest(pairs[j], cur[j + 1] - 1) + j END) AS level FROM (
 SELECT q.user_id, tab.i + 1 AS i, tab.cur, len(q.b) AS m, list_transform(range(1, len(q.b) + 1), lambda j: tab.cur[j] + {gain}) AS pairs FROM tab JOIN q ON q.user_id = tab.user_id WHERE tab.i < len(q.a))))"""
_WAY = """,
walk AS (SELECT user_id, len(a) AS i, len(b) AS j, 1 AS step FROM q UNION ALL
SELECT w.user_id, w.i - CASE WHEN w.move <> 2 THEN 1 ELSE 0 END, w.j - CASE WHEN w.move <> 1 THEN 1 ELSE 0 END, step + 1 FROM (
 SELECT walk.user_id, walk.i, walk.j, step, CASE WHEN walk.i = 0 THEN 2 WHEN walk.j = 0 THEN 1 WHEN tab.cur[walk.j + 1] = tab.pairs[walk.j] THEN 0 WHEN tab.cur[walk.j + 1] = tab.prev[walk.j + 1] - 1 THEN 1 ELSE 2 END AS move
 FROM walk JOIN tab ON tab.user_id = walk.user_id AND tab.i = walk.i WHERE walk.i > 0 OR walk.j > 0) w),
hit AS (SELECT walk.user_id, walk.i, walk.j FROM walk JOIN tab ON tab.user_id = walk.user_id AND tab.i = walk.i WHERE walk.i > 0 AND walk.j > 0 AND tab.cur[walk.j + 1] = tab.pairs[walk.j])"""
_SCORE = " SELECT q.user_id, round(tab.cur[-1] / 20::DOUBLE, 6) AS score FROM tab JOIN q ON q.user_id = tab.user_id AND tab.i = len(q.a)"
_PLAIN = "CASE WHEN q.a[tab.i + 1] = q.b[j] THEN 10 ELSE -10 END"
# the last forced pair of a cell's row or column says what it gains
_ANCHORED = """WITH RECURSIVE e AS (SELECT user_id, event_id, event_type, CAST(floor(value / 3) AS BIGINT) AS j, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events),
t AS (SELECT user_id, list(event_type ORDER BY r) AS a, coalesce(list({{'i': r, 'j': j + 1}} ORDER BY r) FILTER (event_type IN ('purchase', 'signup') AND event_id % 3 = 0), []) AS forced,
 coalesce(list({{'i': r, 'j': j + 1}}) FILTER (event_type = 'error'), []) AS barred FROM e GROUP BY user_id),
q AS (SELECT x.user_id, x.a, y.a AS b, list_filter(x.forced, lambda f: f.j <= len(y.a)) AS forced, x.barred FROM t x JOIN t y ON y.user_id = x.user_id + 1)"""
_CELL = """CASE WHEN len(list_filter(q.forced, lambda f: f.i = tab.i + 1 OR f.j = j)) > 0 THEN CASE WHEN list_filter(q.forced, lambda f: f.i = tab.i + 1 OR f.j = j)[-1] = {'i': tab.i + 1, 'j': j} THEN 100 ELSE -100 END
 WHEN list_contains(q.barred, {'i': tab.i + 1, 'j': j}) THEN -30 ELSE """ + _PLAIN + " END"
_FIRSTS = "CASE WHEN fa > 0 AND fb > 0 AND tab.i + 1 = fa AND j = fb THEN 100 WHEN fa > 0 AND fb > 0 AND (tab.i + 1 = fa OR j = fb) THEN -100 ELSE " + _PLAIN + " END"

_ALLOWED = """({b}.pos IS NULL OR {n}.pos IS NULL OR {n}.pos - {b}.pos <= 12) AND ({b}.pos IS NULL OR c.pos >= {b}.pos) AND ({n}.pos IS NULL OR c.pos <= {n}.pos) AND c.sim > 0.5::DOUBLE
 AND CASE WHEN c.pos = {n}.pos THEN {n}.y0 ELSE 720 END - CASE WHEN c.pos = {b}.pos THEN {b}.y1 ELSE 0 END >= 20 AND c.y0 >= CASE WHEN c.pos = {b}.pos THEN {b}.y1 ELSE 0 END AND c.y1 <= CASE WHEN c.pos = {n}.pos THEN {n}.y0 ELSE 720 END"""
# pair by pair: the place before is where the search has put it, the one behind where it was
_SEARCH = f"""WITH RECURSIVE h AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS j, (epoch_us(ts) - 1704067200000000) // 3600000000 AS h FROM events),
e AS (SELECT *, h // 72 AS pos, h % 72 * 10 AS y0, h % 72 * 10 + 8 AS y1, event_id % 97 / 100 AS sim FROM h),
cand AS MATERIALIZED (SELECT t.user_id, t.j, x.pos, x.y0 + x.event_id % 3 AS y0, x.y1 + x.event_id % 3 AS y1, (t.event_id * 31 + x.event_id * 17) % 100 / 100 AS sim FROM e t JOIN e x ON x.user_id = t.user_id AND x.j BETWEEN t.j - 4 AND t.j + 4),
p AS MATERIALIZED (SELECT user_id, j, pos, y0, y1, sim, event_type = 'view' AND round(sim, 4) < 0.65::DOUBLE AS doubtful, row_number() OVER w AS n, lead(pos) OVER w AS npos, lead(y0) OVER w AS ny0 FROM e WHERE event_type <> 'error' WINDOW w AS (PARTITION BY user_id ORDER BY j)),
st AS (SELECT user_id, 0::BIGINT AS n, NULL::BIGINT AS j, NULL::BIGINT AS pos, NULL::BIGINT AS y0, NULL::BIGINT AS y1, NULL::DOUBLE AS sim, false AS moved FROM (SELECT DISTINCT user_id FROM p)
UNION ALL
SELECT user_id, n, j, CASE WHEN ok THEN f.pos ELSE pos END, CASE WHEN ok THEN f.y0 ELSE y0 END, CASE WHEN ok THEN f.y1 ELSE y1 END, CASE WHEN ok THEN -f.k ELSE sim END, ok FROM (
 SELECT *, coalesce(doubtful AND -f.k > sim, false) AS ok FROM (
 SELECT p.user_id, p.n, p.j, p.pos, p.y0, p.y1, p.sim, p.doubtful, m.f FROM st JOIN p ON p.user_id = st.user_id AND p.n = st.n + 1
 LEFT JOIN (SELECT st.user_id, p.n, min({{'k': -c.sim, 'pos': c.pos, 'y0': c.y0, 'y1': c.y1}}) AS f FROM st JOIN p ON p.user_id = st.user_id AND p.n = st.n + 1 JOIN cand c ON c.user_id = p.user_id AND c.j = p.j
  WHERE {_ALLOWED.replace("{n}.pos", "p.npos").replace("{n}.y0", "p.ny0").format(b="st")} GROUP BY ALL) m ON m.user_id = p.user_id AND m.n = p.n)))"""

ORACLE_SQL = {
    "search_replace": f"{_SEARCH} SELECT user_id, j, pos, y0, y1, round(sim, 6) AS sim, moved FROM st WHERE n > 0",
    "search_recover": f"""{_SEARCH}, q AS (SELECT user_id, j, false AS lost, {{'pos': pos, 'y0': y0, 'y1': y1}} AS place FROM st WHERE n > 0 UNION ALL SELECT user_id, j, true, NULL FROM e WHERE event_type = 'error'),
g AS (SELECT user_id, j, lost, last_value(place IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b, first_value(place IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY j ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS n FROM q),
r AS (SELECT g.user_id, g.j, min({{'k': -c.sim, 'pos': c.pos, 'y0': c.y0, 'y1': c.y1}}) AS f FROM g JOIN cand c ON c.user_id = g.user_id AND c.j = g.j WHERE lost AND {_ALLOWED.format(b="g.b", n="g.n")} GROUP BY ALL)
SELECT g.user_id, g.j, f.pos, f.y0, f.y1, round(-f.k, 6) AS sim FROM g LEFT JOIN r USING (user_id, j) WHERE lost""",
    "align_score_whole": _PAIRED + ", q AS (SELECT * FROM p)" + _ROWS.format(gain=_PLAIN) + _SCORE,
    "align_path_whole": _PAIRED + ", q AS (SELECT * FROM p)" + _ROWS.format(gain=_PLAIN) + _WAY + " SELECT user_id, i, j FROM hit",
    "align_forced_whole": _PAIRED + ", q AS (SELECT *, coalesce(list_position(a, 'purchase'), 0) AS fa, coalesce(list_position(b, 'purchase'), 0) AS fb FROM p)" + _ROWS.format(gain=_FIRSTS) + _SCORE,
    "align_anchored": _ANCHORED.format() + _ROWS.format(gain=_CELL) + _SCORE,
    "align_anchored_path": _ANCHORED.format() + _ROWS.format(gain=_CELL) + _WAY + " SELECT user_id, i, j FROM hit",
    "cell_components": """WITH RECURSIVE c AS (SELECT DISTINCT user_id, epoch_us(ts) // 3600000000 % 24 AS x, epoch_us(ts) // 86400000000 AS y FROM events),
reach AS (SELECT user_id, x, y, x AS rx, y AS ry FROM c UNION SELECT r.user_id, r.x, r.y, c.x, c.y FROM reach r JOIN c ON c.user_id = r.user_id AND c.x BETWEEN r.rx - 1 AND r.rx + 1 AND c.y BETWEEN r.ry - 1 AND r.ry + 1),
m AS (SELECT user_id, x, y, min(ry * 24 + rx) AS k FROM reach GROUP BY ALL)
SELECT user_id, count(*) AS area, min(x) AS x0, min(y) AS y0, max(x) + 1 AS x1, max(y) + 1 AS y1 FROM m GROUP BY user_id, k""",
    "islands_gap": f"{_ISLANDS} SELECT * FROM islands",
    "islands_threshold": """WITH h AS (SELECT event_type, CAST(floor(epoch_us(ts) / 3600000000) AS BIGINT) AS h, count(*) AS n FROM events GROUP BY ALL HAVING count(*) >= 2),
f AS (SELECT *, CASE WHEN h - lag(h) OVER (PARTITION BY event_type ORDER BY h) > 3 THEN 1 ELSE 0 END AS b FROM h),
g AS (SELECT *, sum(b) OVER (PARTITION BY event_type ORDER BY h ROWS UNBOUNDED PRECEDING) AS i FROM f)
SELECT event_type, min(h) AS start, max(h) + 1 AS "end" FROM g GROUP BY event_type, i HAVING max(h) + 1 - min(h) >= 3""",
    "nms_greedy": f"""WITH RECURSIVE x AS ({_SPANS}), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS k FROM x),
st AS (SELECT user_id, 0::BIGINT AS k, []::STRUCT(s BIGINT, e BIGINT)[] AS kept, NULL::BIGINT AS event_id, NULL::BIGINT AS s, NULL::BIGINT AS e, NULL::DOUBLE AS value, false AS ok FROM (SELECT DISTINCT user_id FROM x)
UNION ALL
SELECT y.user_id, y.k, CASE WHEN y.ok THEN list_append(y.kept, {{'s': y.s, 'e': y.e}}) ELSE y.kept END, y.event_id, y.s, y.e, y.value, y.ok FROM (
SELECT st.user_id, r.k, st.kept, r.event_id, r.s, r.e, r.value, len(list_filter(st.kept, lambda q: greatest(least(r.e, q.e) - greatest(r.s, q.s), 0)::DOUBLE / greatest(least(r.e - r.s, q.e - q.s), 1) > 0.25)) = 0 AS ok
FROM st JOIN r ON r.user_id = st.user_id AND r.k = st.k + 1) y)
SELECT user_id, event_id, s, e, value FROM st WHERE ok""",
    "interval_overlap_pairs": f"""WITH x AS ({_SPANS}), n AS (SELECT *, lead(event_id) OVER w AS ni, lead(s) OVER w AS ns, lead(e) OVER w AS ne FROM x WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
SELECT user_id, event_id, ni AS next_id, round(greatest(least(e, ne) - greatest(s, ns), 0)::DOUBLE / greatest(least(e - s, ne - ns), 1), 6) AS overlap FROM n WHERE ni IS NOT NULL""",
    "interval_iou_label": f"""WITH x AS ({_SPANS}), j AS (SELECT a.user_id, a.event_id, max(coalesce(greatest(least(a.e, b.e) - greatest(a.s, b.s), 0)::DOUBLE / greatest((a.e - a.s) + (b.e - b.s) - greatest(least(a.e, b.e) - greatest(a.s, b.s), 0), 1), 0)) AS iou
FROM x a LEFT JOIN x b ON a.user_id = b.user_id AND b.event_type = 'purchase' WHERE a.event_type = 'click' GROUP BY ALL)
SELECT user_id, event_id, CASE WHEN iou >= 0.5 THEN 1 ELSE 0 END::BIGINT AS label, round(iou, 6) AS iou FROM j WHERE iou >= 0.5 OR iou <= 0.3""",
    "box_iou_pairs": """WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey % 50 AS x0, l_suppkey % 10 AS y0, l_partkey % 50 + l_quantity::BIGINT AS x1, l_suppkey % 10 + l_linenumber * 5 AS y1 FROM lineitem),
p AS (SELECT a.l_orderkey, a.l_linenumber AS la, b.l_linenumber AS lb, greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0) AS c, (a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) AS t
FROM b a JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber)
SELECT l_orderkey, la::BIGINT AS line_a, lb::BIGINT AS line_b, round(c::DOUBLE / greatest(t - c, 1), 6) AS iou FROM p WHERE c::DOUBLE / greatest(t - c, 1) > 0.3""",
    "run_pairs_bounded": f"""{_ISLANDS}, o AS (SELECT user_id, start_us AS s, end_us AS e, CASE WHEN start_us - lag(end_us) OVER (PARTITION BY user_id ORDER BY start_us) > 77760000000 THEN 1 ELSE 0 END AS b FROM islands),
c AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS chain FROM o)
SELECT x.user_id, x.s, y.e FROM c x JOIN c y ON x.user_id = y.user_id AND x.chain = y.chain AND y.s >= x.s AND y.e - x.s BETWEEN 103680000000 AND 194400000000""",
    "marker_partition": """WITH e AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seen, count(*) OVER (PARTITION BY user_id) AS total FROM events),
m AS (SELECT user_id, seen, total, total // 4 AS p, row_number() OVER (PARTITION BY user_id ORDER BY seen) AS k FROM e WHERE event_type = 'signup'),
c AS (SELECT a.user_id, a.k AS m1, b.k AS m2, c.k AS m3, abs(a.seen - a.p) + abs(b.seen - a.seen - a.p) + abs(c.seen - b.seen - a.p) + abs(a.total - c.seen - (a.total - 3 * a.p)) AS cost
FROM m a JOIN m b ON a.user_id = b.user_id AND a.k < b.k JOIN m c ON b.user_id = c.user_id AND b.k < c.k),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY cost, m3, m2, m1) AS n FROM c)
SELECT user_id, m1, m2, m3, cost::BIGINT AS cost FROM r WHERE n = 1""",
    "neighbour_fill": """SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
first_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM events""",
    "sandwich_promote": """WITH o AS (SELECT *, lag(o_orderstatus) OVER w AS p, lead(o_orderstatus) OVER w AS n FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_totalprice >= 50000 AND p <> 'O' AND n <> 'O' THEN 'aligned' WHEN o_orderstatus = 'O' THEN 'inferred' ELSE 'anchored' END AS status FROM o""",
}
ORACLE_SQL["nms_rounds"] = ORACLE_SQL["nms_greedy"]
ORACLE_SQL |= {name: ORACLE_SQL[f"{name}_whole"] for name in ("align_score", "align_forced", "align_path")}
