"""The work list over parts as rows of a provenance table, customers as wanted items and modern names, orders as drawn glyphs."""

from pyspark.sql import functions as F

from tessella.functions import scalars as S
from tessella.operators import worklist as W
from tessella.session import prepare, table


def _code(c):
    return S.hex5(F.lit(0x30000) + F.col(c))


def _rows(spark, sf_dir):
    """Every part is a row; those of some sizes have been rejected and have no code point."""
    k, s = F.col("p_partkey"), F.col("p_size").cast("long")
    status = F.when(s % 5 == 0, "inferred").when(s % 5 == 1, "manual").when(s % 5 == 2, "rejected").otherwise("aligned")
    p = table(prepare(spark), sf_dir, "part")
    return p.select(
        F.when(s % 5 == 2, "").otherwise(_code("p_partkey")).alias("codepoint"), F.format_string("S%05d", k).alias("sequence"), F.col("p_brand").alias("title"), (k % 40).alias("page"), F.when(k % 2 == 0, "right").otherwise("left").alias("side"),
        (k * 7 % 900).alias("x"), (k * 11 % 700).alias("y"), s.alias("w"), (s + k % 5).alias("h"), F.when(k % 3 == 0, "inline").otherwise("headword").alias("kind"), (k * 13 % 101 / 100).alias("similarity"), status.alias("status"),
        (k % 25).alias("juan"), (k % 540).alias("radical"), k.alias("k"),
    )


def _glyphs(spark, sf_dir, *more):
    rows, c = _rows(spark, sf_dir), table(spark, sf_dir, "customer")
    modern = c.filter("c_custkey % 3 <> 1").select(_code("c_custkey").alias("codepoint"), F.col("c_mktsegment").alias("modern"))
    drawn = table(spark, sf_dir, "orders").select(_code("o_custkey").alias("codepoint"))
    return W.glyphs(rows, rows.filter("k % 11 = 4"), modern, drawn, F.col("modern").isin("BUILDING", "MACHINERY"))


def _missing(spark, sf_dir):
    wanted = table(spark, sf_dir, "customer").select(_code("c_custkey").alias("codepoint"), (F.col("c_custkey") % 25).alias("juan"), F.col("c_custkey").alias("k"))
    return W.missing_items(wanted, _rows(spark, sf_dir).filter("codepoint <> ''"), "k")


def _halves(spark, sf_dir):
    return _rows(spark, sf_dir).groupBy(*W.HALF).agg(F.min("y").alias("top"), F.max(F.col("y") + F.col("h")).alias("bottom"), F.min("juan").alias("juan"), F.count_if(F.col("codepoint") == "").alias("spare"))


def review_glyphs(spark, sf_dir):
    """All fields of the items and what is derived from them [P1 J1 J2]."""
    return _glyphs(spark, sf_dir).withColumn("similarity", S.r6(F.col("similarity")))


def review_missing(spark, sf_dir):
    """Wanted items without a row and what stands before them [M7]."""
    return _missing(spark, sf_dir).select("codepoint", "juan", *[F.col(f"after.{c}").alias(f"after_{c}") for c in ("codepoint", "page", "side", "title")])


def review_filters(spark, sf_dir):
    """What each filter of the work list shows [P20]."""
    return W.filtered(_glyphs(spark, sf_dir))


def state_lines(spark, sf_dir):
    """The state document: items, missing and rejected ones and half pages, a line each [M7]."""
    g, m, h = _glyphs(spark, sf_dir), _missing(spark, sf_dir), _halves(spark, sf_dir)
    rejected = _rows(spark, sf_dir).filter("codepoint = ''").select("juan", *W.HALF, "x", "y", "w", "h")
    return W.lines(glyph=g.select("juan", "codepoint", "status", "modern", "common", "has_glyph", "page"), missing=m.select("juan", "codepoint", "after"), rejected=rejected, half=h.select("juan", *W.HALF, "top", "bottom", "spare"))


_VERBS = {"click": "rebox", "view": "comment", "purchase": "reject", "signup": "delete", "error": "reassign"}


def feedback_on_halves(spark, sf_dir):
    """A log's events as corrections, on half pages that are known [J22 M6]: an event's user is its item."""
    ev = table(prepare(spark), sf_dir, "events")
    verb = F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in _VERBS.items()])
    at = F.col("event_id")
    events = ev.select(
        at.alias("ident"), verb.alias("verb"), F.concat(F.lit("Brand#"), (at % 26).cast("string")).alias("title"), (at % 45).alias("page"), F.when(at % 2 == 0, "right").otherwise("left").alias("side"),
        _code("user_id").alias("codepoint"), S.hex5(F.lit(0x30001) + F.col("user_id")).alias("new_codepoint"), (at % 900).alias("x"), (at % 700).alias("y"), (at % 50).alias("w"), (at % 60).alias("h"),
    )
    return W.corrections(events, _halves(spark, sf_dir)).withColumnRenamed("ident", "event_id")


QUERIES = {f.__name__: f for f in (review_glyphs, review_missing, review_filters, state_lines, feedback_on_halves)}

_SQL = """r AS (SELECT CASE WHEN p_size % 5 = 2 THEN '' ELSE printf('%05X', 196608 + p_partkey) END AS codepoint, printf('S%05d', p_partkey) AS sequence, p_brand AS title, p_partkey % 40 AS page, CASE WHEN p_partkey % 2 = 0 THEN 'right' ELSE 'left' END AS side,
 p_partkey * 7 % 900 AS x, p_partkey * 11 % 700 AS y, p_size::BIGINT AS w, p_size + p_partkey % 5 AS h, CASE WHEN p_partkey % 3 = 0 THEN 'inline' ELSE 'headword' END AS kind, p_partkey * 13 % 101 / 100 AS similarity,
 CASE p_size % 5 WHEN 0 THEN 'inferred' WHEN 1 THEN 'manual' WHEN 2 THEN 'rejected' ELSE 'aligned' END AS status, p_partkey % 25 AS juan, p_partkey % 540 AS radical, p_partkey AS k FROM part),
g AS (SELECT r.* REPLACE (CASE WHEN k % 11 = 4 THEN 'approved' ELSE status END AS status), coalesce(c_mktsegment, '') AS modern, coalesce(c_mktsegment IN ('BUILDING', 'MACHINERY'), false) AS common, k IN (SELECT o_custkey FROM orders) AS has_glyph
 FROM r LEFT JOIN customer ON c_custkey = k AND c_custkey % 3 <> 1 WHERE codepoint <> ''),
h AS (SELECT title, page, side, min(y) AS top, max(y + h) AS bottom, min(juan) AS juan, count_if(codepoint = '') AS spare FROM r GROUP BY ALL),
m AS (SELECT printf('%05X', 196608 + c_custkey) AS codepoint, c_custkey % 25 AS juan, (SELECT {'codepoint': g.codepoint, 'page': g.page, 'side': g.side, 'title': g.title} FROM g WHERE g.juan = c_custkey % 25 AND g.k < c_custkey ORDER BY g.k DESC LIMIT 1) AS after
 FROM customer WHERE c_custkey NOT IN (SELECT k FROM g))"""

ORACLE_SQL = {
    "review_glyphs": f"WITH {_SQL} SELECT * EXCLUDE (k) REPLACE (round(similarity, 6) AS similarity) FROM g",
    "review_missing": f"WITH {_SQL} SELECT codepoint, juan, after.codepoint AS after_codepoint, after.page AS after_page, after.side AS after_side, after.title AS after_title FROM m",
    "review_filters": f"""WITH {_SQL} SELECT 'todo' AS "view", codepoint, juan FROM g WHERE common AND status = 'inferred' UNION ALL SELECT 'open', codepoint, juan FROM g WHERE common AND status <> 'approved' UNION ALL SELECT 'all', codepoint, juan FROM g WHERE common
UNION ALL SELECT 'low', codepoint, juan FROM g WHERE common AND status <> 'approved' AND (status = 'inferred' OR round(similarity, 4) < 0.8::DOUBLE)""",
    "state_lines": f"""WITH {_SQL} SELECT juan, 'glyph' AS part, CAST(to_json({{'juan': juan, 'codepoint': codepoint, 'status': status, 'modern': modern, 'common': common, 'has_glyph': has_glyph, 'page': page}}) AS VARCHAR) AS doc FROM g
UNION ALL SELECT juan, 'missing', CAST(to_json({{'juan': juan, 'codepoint': codepoint, 'after': after}}) AS VARCHAR) FROM m
UNION ALL SELECT juan, 'rejected', CAST(to_json({{'juan': juan, 'title': title, 'page': page, 'side': side, 'x': x, 'y': y, 'w': w, 'h': h}}) AS VARCHAR) FROM r WHERE codepoint = ''
UNION ALL SELECT juan, 'half', CAST(to_json({{'juan': juan, 'title': title, 'page': page, 'side': side, 'top': top, 'bottom': bottom, 'spare': spare}}) AS VARCHAR) FROM h""",
    "feedback_on_halves": f"""WITH {_SQL} SELECT event_id, h.title, h.page, h.side, h.juan, CASE event_type WHEN 'purchase' THEN 'reject' WHEN 'signup' THEN 'not' ELSE 'assign' END AS action,
 CASE event_type WHEN 'purchase' THEN NULL WHEN 'error' THEN printf('%05X', 196609 + user_id) ELSE printf('%05X', 196608 + user_id) END AS codepoint, event_id % 900 AS x, event_id % 700 AS y, event_id % 50 AS w, event_id % 60 AS h
FROM events JOIN h ON h.title = 'Brand#' || event_id % 26 AND h.page = event_id % 45 AND h.side = CASE WHEN event_id % 2 = 0 THEN 'right' ELSE 'left' END WHERE event_type IN ('click', 'purchase', 'signup', 'error')""",
}
