"""Review queries over parts, orders and customers as items, boxes and pages; ids of the survey's operators in brackets."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessella import session
from tessella.functions import scalars as S
from tessella.operators import review as V
from tessella.plans.records import status_classify, status_summary
from tessella.session import prepare, table


def _items(spark, sf_dir):
    """Parts as items: a code, a block, a status, a similarity; every seventh is common."""
    p = table(prepare(spark), sf_dir, "part")
    status = F.when(F.col("p_size") % 5 == 0, "inferred").when(F.col("p_size") % 5 == 1, "manual").when(F.col("p_size") % 5 == 2, "rejected").otherwise("aligned")
    return p.select("p_partkey", S.hex5(F.lit(0x30000) + F.col("p_partkey")).alias("code"), (F.col("p_partkey") % 25).alias("block"), status.alias("status"), (F.col("p_retailprice") % 100 / 100).alias("similarity"), (F.col("p_partkey") % 7 == 0).alias("common"), "p_name")


_ITEMS = "i AS (SELECT p_partkey, printf('%05X', 196608 + p_partkey) AS code, p_partkey % 25 AS block, CASE p_size % 5 WHEN 0 THEN 'inferred' WHEN 1 THEN 'manual' WHEN 2 THEN 'rejected' ELSE 'aligned' END AS status, p_retailprice % 100 / 100 AS similarity, p_partkey % 7 = 0 AS common, p_name FROM part)"
_APPROVED = "p_partkey % 11 = 4"


def review_rows(spark, sf_dir):
    """An item's fields with its modern text ('' by default), and approved where it is in the approved set [P1 J1 J2 J3]."""
    i = _items(spark, sf_dir)
    modern = table(spark, sf_dir, "customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("p_partkey"), F.col("c_mktsegment").alias("modern"))
    ok = i.filter(_APPROVED).select("p_partkey", F.lit("approved").alias("status"))
    return V.overridden(V.with_default(i, modern, "p_partkey", "modern", ""), ok, "p_partkey", "status").select("code", "block", "status", S.r6(F.col("similarity")).alias("similarity"), "modern", "common")


def traced(spark, sf_dir):
    """Rows of a traced status, of a set of lines only [P2 P3]."""
    return status_classify(spark, sf_dir).filter(F.col("status").isin(*V.TRACED) & F.col("l_linenumber").isin(1, 3))


def approvals(spark, sf_dir):
    """The approved set after approving the traced items of a block and taking some back [J4 M6]."""
    i = _items(spark, sf_dir)
    now = V.approve(i.filter(_APPROVED).select("p_partkey"), i.filter("block = 3"), "p_partkey")
    return V.unapprove(now, i.filter("p_partkey % 5 = 0"), "p_partkey")


def review_counts(spark, sf_dir):
    """Open, shown and sure items by block: shown if common, open if not approved, sure from a similarity of 0.9 on and not inferred [P20 P21 G18]."""
    i = _items(spark, sf_dir).withColumn("approved", F.expr(_APPROVED))
    return i.groupBy("block").agg(F.count_if(~F.col("approved")).alias("open"), F.count_if("common").alias("shown"), F.count_if((F.col("status") == "inferred") & F.col("common")).alias("todo"),
                                  F.count_if(~F.col("approved") & (F.col("status") != "inferred") & (F.round("similarity", 4) >= 0.9)).alias("sure"))


def state_document(spark, sf_dir):
    """A JSON document a block [M7]."""
    c = review_counts(spark, sf_dir)
    return c.select("block", F.to_json(F.struct("block", "open", "todo")).alias("doc"))


def wanted_pages(spark, sf_dir):
    """Pages of a supplier's two ranges, less those to skip and those that are there already; a page of both ranges comes twice [P6 A12]."""
    s = table(prepare(spark), sf_dir, "supplier").select("s_suppkey")
    at = F.col("s_suppkey") * 10
    pages = s.select("s_suppkey", F.explode(F.concat(F.sequence(at, at + F.col("s_suppkey") % 7), F.sequence(at + 3, at + 5))).alias("page"))
    skip = pages.filter("page % 4 = 1").select("s_suppkey", "page").distinct()
    there = table(spark, sf_dir, "part").filter("p_size > 25").select(F.col("p_partkey").alias("page"))
    return pages.join(skip, ["s_suppkey", "page"], "left_anti").join(there, "page", "left_anti").select("s_suppkey", "page")


def rewritten_urls(spark, sf_dir):
    """URLs with their only match rewritten, and widths of a fixed list [P7 P9]."""
    p = table(prepare(spark), sf_dir, "pages").select(F.col("page_id").cast("long").alias("page_id"), "url")
    return p.select("page_id", V.rewrite_once(F.col("url"), "e", "E", False).alias("once"), V.rewrite_once(F.col("url"), "://", "://mirror.", False).alias("url"), (F.col("page_id") % 400 + 100).isin(120, 250, 330, 500).alias("allowed"))


def touched_blocks(spark, sf_dir):
    """Suppliers of the blocks 3, 5 or 8 whose pages meet the requested ones [P10 U4]."""
    s = table(prepare(spark), sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").cast("long").alias("block"))
    pages = F.sequence(F.col("s_suppkey"), F.col("s_suppkey") + F.col("block"))
    return s.filter(F.array_contains(F.split(F.lit("3,5,8"), ","), F.col("block").cast("string")) & F.arrays_overlap(pages, F.array(*[F.lit(x).cast("long") for x in (7, 40, 41, 77)])))


def resolved_texts(spark, sf_dir):
    """Texts as codes or as parts of names: none, one or many, the first eight listed [P18]."""
    i = _items(spark, sf_dir)
    wanted = i.filter("p_partkey <= 12").select(F.substring("p_name", 2, 4).alias("text")).unionByName(i.filter("p_partkey % 500 = 7").select(F.col("code").alias("text"))).unionByName(i.filter("p_partkey = 1").select(F.lit("30G").alias("text")))
    with session.scratch(spark):
        return V.resolve_text(wanted, i, "text", "code", "p_name").select("text", "n", F.array_join("hits", " ").alias("hits")).checkpoint(eager=True)


def common_flags(spark, sf_dir):
    """Whether an item's character is a common one [P19]: characters from the item's number."""
    i = _items(spark, sf_dir).select("p_partkey", S.character(F.lit(0x4E00) + F.col("p_partkey") % 20000).alias("ch"))
    return V.with_common(i, "ch")


def output_rows(spark, sf_dir):
    """Boxes by corners as rows of place and size; no sequence or code becomes blank [P26]."""
    l = table(prepare(spark), sf_dir, "lineitem")
    x, y = F.col("l_partkey") % 40, F.col("l_suppkey") % 10
    corner = F.struct(x.alias("x0"), y.alias("y0"), (x + F.col("l_quantity").cast("long")).alias("x1"), (y + 20).alias("y1"))
    df = l.select("l_orderkey", "l_partkey", "l_suppkey", corner.alias("b"), F.col("l_linenumber").cast("long").alias("n"))
    blank = lambda c: F.when(c.isNull() | (c == 0), "").otherwise(c.cast("string"))
    return df.select("l_orderkey", "l_partkey", "l_suppkey", F.col("b.x0").alias("x"), F.col("b.y0").alias("y"), (F.col("b.x1") - F.col("b.x0")).alias("w"), (F.col("b.y1") - F.col("b.y0")).alias("h"), blank(F.col("n") % 3).alias("sequence"))


def exempt_rows(spark, sf_dir):
    """Items that keep their lines: their upper-cased code is in the exemption set [P27]."""
    i = _items(spark, sf_dir)
    keep = i.filter("p_partkey % 9 = 2").select(F.upper(F.lower("code")).alias("code")).distinct()
    return i.join(keep.withColumn("exempt", F.lit(True)), "code", "left").select("code", F.coalesce("exempt", F.lit(False)).alias("exempt"))


def forced_gains(spark, sf_dir):
    """Cells that forced pairs leave in a table of gains: pairs of a line's number and its part's last digit, of this block only [J13 D5]."""
    l = table(prepare(spark), sf_dir, "lineitem").filter("l_suppkey % 4 = 1").select("l_orderkey", F.col("l_linenumber").cast("long").alias("i"), (F.col("l_partkey") % 10).alias("j"))
    return V.forced_cells(l, ["l_orderkey"])


def forbidden_similarity(spark, sf_dir):
    """Similarities of an order's lines to suppliers' last digits, -1 where the pair is forbidden [J12 J14]."""
    from tessella.operators import overlay as O

    l = table(prepare(spark), sf_dir, "lineitem").groupBy("l_orderkey", F.col("l_linenumber").cast("long").alias("line")).agg((F.min("l_suppkey") % 10).alias("t"), F.max("l_discount").alias("score"))
    rows = l.filter("line % 2 = 0").select("l_orderkey", "line", F.array(F.col("t")).alias("forbid"))
    return O.forbidden_pairs(rows, ["l_orderkey", "line"], l, "t", "score").select("l_orderkey", "line", "t", S.r6(F.col("score")).alias("score"))


def between_neighbours(spark, sf_dir):
    """For each missing item (an order of status P) the number of places between its present neighbours, none if they are over 12 apart [J16]."""
    o = table(prepare(spark), sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    v = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderkey"))
    there = F.when(F.col("o_orderstatus") != "P", F.col("nth"))
    o = o.withColumn("nth", F.row_number().over(w).cast("long"))
    o = o.withColumn("a", F.last(there, True).over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn("b", F.last(there, True).over(v.rowsBetween(Window.unboundedPreceding, -1)))
    return o.filter("o_orderstatus = 'P'").select("o_orderkey", F.when(F.col("b") - F.col("a") <= 12, F.col("b") - F.col("a") - 1).alias("places"))


def labels_above(spark, sf_dir):
    """For each glyph (a line of flag N) the lowest label (flag R) above it within ten columns of the same page [J17]."""
    l = table(prepare(spark), sf_dir, "lineitem").select("l_orderkey", (F.col("l_partkey") % 40).alias("x"), (F.col("l_suppkey") % 97).alias("y"), "l_returnflag")
    labels = l.filter("l_returnflag = 'R'").select("l_orderkey", F.col("x").alias("lx"), F.col("y").alias("ly"))
    j = l.filter("l_returnflag = 'N'").join(labels, "l_orderkey", "left")
    above = F.when((F.col("ly") < F.col("y")) & (F.abs(F.col("lx") - F.col("x")) <= 10), F.col("ly"))
    return j.groupBy("l_orderkey", "x", "y").agg(F.max(above).alias("label"))


def missing_candidates(spark, sf_dir):
    """For each missing item the first eight boxes, rejected ones and near misses, of its predecessor's page [J18 U5]."""
    o = table(prepare(spark), sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", F.lag("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("before"))
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("before"), F.col("l_linenumber").cast("long").alias("line"), "l_partkey", "l_suppkey", "l_returnflag")
    rejected = l.filter("l_returnflag = 'R'").withColumn("kind", F.lit("rejected"))
    near = l.filter("l_returnflag = 'A'").withColumn("kind", F.lit("near"))
    j = o.filter("o_orderstatus = 'P'").join(rejected.unionByName(near), "before")
    w = Window.partitionBy("o_orderkey").orderBy(F.desc("kind"), "line", "l_partkey", "l_suppkey")
    return j.withColumn("r", F.row_number().over(w).cast("long")).filter("r <= 8").select("o_orderkey", "kind", "line", "l_partkey", "r")


def overriding_files(spark, sf_dir):
    """Files of which an override takes the place by name [J19]."""
    p = table(prepare(spark), sf_dir, "part").select("p_name", "p_partkey", "p_size")
    base = p.groupBy("p_name").agg(F.min("p_partkey").alias("file"))
    over = p.filter("p_size = 7").groupBy("p_name").agg(F.max("p_partkey").alias("file"))
    return V.overridden(base, over, "p_name", "file")


_VERBS = {"click": "rebox", "view": "comment", "purchase": "reject", "signup": "delete", "error": "reassign"}


def feedback_corrections(spark, sf_dir):
    """A log's events as corrections [J22]."""
    ev = table(prepare(spark), sf_dir, "events")
    verb = F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in _VERBS.items()])
    return V.corrections(ev.select("event_id", verb.alias("verb"), F.col("user_id").alias("target"), (F.col("user_id") + 1).alias("new_target"))).withColumn("nth", F.col("nth").cast("long"))


def dirty_blocks(spark, sf_dir):
    """Blocks to run again after a user's reassignments: the event's own and those of the items with the old or the new target [J23]."""
    ev = table(prepare(spark), sf_dir, "events").filter("event_type = 'error' and event_id % 40 = 0").select((F.col("event_id") % 25).alias("block"), "user_id")
    touched = ev.select(F.explode(F.array(F.col("user_id"), F.col("user_id") + 1)).alias("p_partkey")).distinct()
    return ev.select("block").unionByName(_items(spark, sf_dir).join(touched, "p_partkey", "left_semi").select("block")).distinct()


def adjusted_counts(spark, sf_dir):
    """Rows by status, with a part of the inferred ones promoted: taken from there and added to the aligned ones [G3]."""
    promoted = status_classify(spark, sf_dir).filter("status = 'inferred' and l_linenumber = 2").agg(F.count("*").alias("p"))
    s = status_summary(spark, sf_dir).select("status", "n").join(F.broadcast(promoted))
    return s.select("status", (F.col("n") + F.when(F.col("status") == "aligned", F.col("p")).when(F.col("status") == "inferred", -F.col("p")).otherwise(0)).alias("n"))


def ordered_lists(spark, sf_dir):
    """A group's members in order: items by block [G1]."""
    return _items(spark, sf_dir).groupBy("block").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "code"))), lambda x: x["code"]), " ").alias("codes"))


def merged_entries(spark, sf_dir):
    """An entry's first and last value in order, and the value that holds where a second table has the key too [G13]."""
    c = table(prepare(spark), sf_dir, "customer").select(F.col("c_nationkey").cast("long").alias("nation"), "c_custkey", "c_mktsegment")
    left = c.groupBy("nation").agg(F.min_by("c_mktsegment", "c_custkey").alias("first"), F.max_by("c_mktsegment", "c_custkey").alias("last")).filter("nation % 2 = 0")
    right = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("nation"), F.col("n_name").alias("right")).filter("nation % 3 = 0")
    return left.join(right, "nation", "full").select("nation", "first", "last", F.coalesce("right", "last").alias("value"))


def held_out_accuracy(spark, sf_dir):
    """The share of labels that a rule meets [G21]: texts of 300 characters or more are good."""
    l, d = table(prepare(spark), sf_dir, "labels"), table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return l.join(d, "doc_id").agg(S.r6(F.avg(((F.col("n_chars") >= 300).cast("int") == F.col("quality")).cast("int"))).alias("accuracy"), F.count("*").alias("n"))


def cleaned_positives(spark, sf_dir):
    """Labels without the positives that other folds do not bear out [M2]: the feature is the document's source."""
    l, d = table(prepare(spark), sf_dir, "labels"), table(spark, sf_dir, "documents").select("doc_id", "source")
    out = V.cleaned_labels(l.join(d, "doc_id").select("doc_id", "source", F.col("toxic").cast("long").alias("toxic")), "source", "toxic", F.col("doc_id") % 3, 0.1)
    return out.select("doc_id", "toxic", S.r6(F.col("share")).alias("share"))


def half_neighbours(spark, sf_dir):
    """The half pages before and behind one, clamped at the ends [W12]."""
    o = table(prepare(spark), sf_dir, "orders").select("o_custkey", "o_orderkey")
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    return o.select("o_orderkey", F.coalesce(F.lag("o_orderkey").over(w), "o_orderkey").alias("back"), F.coalesce(F.lead("o_orderkey").over(w), "o_orderkey").alias("on"))


def book_order(spark, sf_dir):
    """Orders of a customer in the order of a dimension's ranks, unknown ones last, and as they came otherwise [S1]."""
    ranks = F.create_map(*[F.lit(x) for kv in {"5-LOW": 0, "1-URGENT": 1, "3-MEDIUM": 2}.items() for x in kv])
    o = table(prepare(spark), sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    w = Window.partitionBy("o_custkey").orderBy(F.coalesce(F.try_element_at(ranks, "o_orderpriority"), F.lit(99)), "o_orderkey")
    return o.select("o_orderkey", F.row_number().over(w).cast("long").alias("place"))


def last_page(spark, sf_dir):
    """A page beyond the last one is the last one [S4]."""
    return V.page_of(table(prepare(spark), sf_dir, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal", "c_custkey"], 120, 10**6, small=1000)


def deep_page(spark, sf_dir):
    """A page from the middle of the line items by quantity, of which every value has a fiftieth of all rows, then order and part [S4]."""
    li = table(prepare(spark), sf_dir, "lineitem").select("l_quantity", "l_orderkey", "l_partkey")
    return V.page_of(li, ["l_quantity", "l_orderkey", "l_partkey"], 120, 37, small=1000)


def log_tails(spark, sf_dir):
    """The last 80 characters of texts [S5]."""
    return table(prepare(spark), sf_dir, "documents").select("doc_id", F.right(F.coalesce("text", F.lit("")), F.lit(80)).alias("tail"))


def character_classes(spark, sf_dir):
    """Characters of whole texts by class, counted [P25]: in the block and covered (a to m), in it and not covered (n to z), passed through (digits), other."""
    b = table(prepare(spark), sf_dir, "benchmark").select(F.col("item_id").cast("long").alias("item_id"), F.explode(F.split("text", "")).alias("ch"))
    kind = F.when(F.col("ch").between("a", "m"), "covered").when(F.col("ch").between("n", "z"), "uncovered").when(F.col("ch").between("0", "9"), "passed").otherwise("other")
    return b.groupBy("item_id").agg(*[F.count_if(kind == k).alias(k) for k in ("covered", "uncovered", "passed", "other")])


_STAGES = [{"a": "1", "e": "2"}, {"e": "x", "o": "3"}, {"t": "7"}]


def conversion_chain(spark, sf_dir):
    """Characters converted by the first of three tables that has them; others stay [D15]."""
    maps = [F.create_map(*[F.lit(x) for kv in m.items() for x in kv]) for m in _STAGES]
    b = table(prepare(spark), sf_dir, "benchmark").select(F.col("item_id").cast("long").alias("item_id"), "text")
    return b.select("item_id", F.array_join(F.transform(F.split("text", ""), lambda c: F.coalesce(*[F.try_element_at(m, c) for m in maps], c)), "").alias("converted"))


QUERIES = {f.__name__: f for f in (
    review_rows, traced, approvals, review_counts, state_document, wanted_pages, rewritten_urls, touched_blocks, resolved_texts, common_flags, output_rows, exempt_rows, forced_gains, forbidden_similarity, between_neighbours, labels_above,
    missing_candidates, overriding_files, feedback_corrections, dirty_blocks, adjusted_counts, ordered_lists, merged_entries, held_out_accuracy, cleaned_positives, half_neighbours, book_order, last_page, deep_page, log_tails, character_classes, conversion_chain,
)}

_STATUS = "st AS (SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CASE WHEN l_linestatus = 'F' AND l_tax = 0 THEN 'manual' WHEN round(1 - l_discount * 5, 4) >= CASE WHEN l_returnflag = 'N' THEN 0.65::DOUBLE ELSE 0.78::DOUBLE END THEN 'aligned' ELSE 'inferred' END AS status FROM lineitem)"
_COUNTS = f"c AS (SELECT block, count_if(NOT {_APPROVED})::BIGINT AS open, count_if(common)::BIGINT AS shown, count_if(status = 'inferred' AND common)::BIGINT AS todo, count_if(NOT {_APPROVED} AND status <> 'inferred' AND round(similarity, 4) >= 0.9::DOUBLE)::BIGINT AS sure FROM i GROUP BY block)"
_CHAIN = "".join(f" WHEN c = '{k}' THEN '{v}'" for m in _STAGES for k, v in m.items())

ORACLE_SQL = {
    "review_rows": f"WITH {_ITEMS} SELECT code, block, CASE WHEN {_APPROVED} THEN 'approved' ELSE status END AS status, round(similarity, 6) AS similarity, coalesce(c_mktsegment, '') AS modern, common FROM i LEFT JOIN customer ON c_custkey = p_partkey AND c_custkey % 3 = 0",
    "traced": f"WITH {_STATUS} SELECT * FROM st WHERE status IN ('aligned', 'manual', 'approved') AND l_linenumber IN (1, 3)",
    "approvals": f"WITH {_ITEMS} SELECT p_partkey FROM i WHERE ({_APPROVED} OR block = 3 AND status IN ('aligned', 'manual', 'approved')) AND p_partkey % 5 <> 0",
    "review_counts": f"WITH {_ITEMS}, {_COUNTS} SELECT * FROM c",
    "state_document": f"""WITH {_ITEMS}, {_COUNTS} SELECT block, printf('{{"block":%d,"open":%d,"todo":%d}}', block, open, todo) AS doc FROM c""",
    "wanted_pages": "SELECT s_suppkey, page FROM (SELECT s_suppkey, unnest(list_concat(range(s_suppkey * 10, s_suppkey * 10 + s_suppkey % 7 + 1), range(s_suppkey * 10 + 3, s_suppkey * 10 + 6))) AS page FROM supplier) WHERE page % 4 <> 1 AND page NOT IN (SELECT p_partkey FROM part WHERE p_size > 25)",
    "rewritten_urls": "SELECT page_id::BIGINT AS page_id, CASE WHEN length(url) - length(replace(url, 'e', '')) = 1 THEN replace(url, 'e', 'E') END AS once, CASE WHEN length(url) - length(replace(url, '://', '')) = 3 THEN replace(url, '://', '://mirror.') END AS url, page_id % 400 + 100 IN (120, 250, 330, 500) AS allowed FROM pages",
    "touched_blocks": "SELECT s_suppkey, s_nationkey::BIGINT AS block FROM supplier WHERE s_nationkey IN (3, 5, 8) AND len(list_filter([7, 40, 41, 77], lambda x: x BETWEEN s_suppkey AND s_suppkey + s_nationkey)) > 0",
    "resolved_texts": f"""WITH {_ITEMS}, w AS (SELECT substr(p_name, 2, 4) AS t FROM i WHERE p_partkey <= 12 UNION SELECT code FROM i WHERE p_partkey % 500 = 7 UNION SELECT '30G'),
x AS (SELECT t FROM w WHERE regexp_full_match(t, '3[0-9A-F]{{4}}') AND t IN (SELECT code FROM i)), m AS (SELECT w.t, code FROM w JOIN i ON contains(p_name, w.t) WHERE w.t NOT IN (SELECT t FROM x))
SELECT t AS text, 1::BIGINT AS n, t AS hits FROM x UNION ALL SELECT w.t, count(code), coalesce(array_to_string(list(code ORDER BY code) FILTER (code IS NOT NULL)[:8], ' '), '') FROM w LEFT JOIN m ON m.t = w.t WHERE w.t NOT IN (SELECT t FROM x) GROUP BY w.t""",
    "output_rows": "SELECT l_orderkey, l_partkey, l_suppkey, l_partkey % 40 AS x, l_suppkey % 10 AS y, l_quantity::BIGINT AS w, 20::BIGINT AS h, CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE (l_linenumber % 3)::VARCHAR END AS sequence FROM lineitem",
    "exempt_rows": f"WITH {_ITEMS} SELECT code, p_partkey % 9 = 2 AS exempt FROM i",
    "forced_gains": """WITH p AS (SELECT DISTINCT l_orderkey, l_linenumber::BIGINT AS i, l_partkey % 10 AS j FROM lineitem WHERE l_suppkey % 4 = 1)
SELECT *, CASE WHEN EXISTS (FROM p q WHERE q.l_orderkey = p.l_orderkey AND (q.i > p.i AND q.j = p.j OR q.i = p.i AND q.j > p.j)) THEN -5.0::DOUBLE ELSE 5.0::DOUBLE END AS gain FROM p""",
    "forbidden_similarity": "SELECT l_orderkey, l_linenumber::BIGINT AS line, min(l_suppkey) % 10 AS t, CASE WHEN l_linenumber % 2 = 0 THEN -1.0::DOUBLE ELSE round(max(l_discount), 6) END AS score FROM lineitem GROUP BY l_orderkey, l_linenumber",
    "between_neighbours": """WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS nth FROM orders), n AS (SELECT p.o_orderkey, (SELECT max(a.nth) FROM o a WHERE a.o_custkey = p.o_custkey AND a.nth < p.nth AND a.o_orderstatus <> 'P') AS a, (SELECT min(b.nth) FROM o b WHERE b.o_custkey = p.o_custkey AND b.nth > p.nth AND b.o_orderstatus <> 'P') AS b FROM o p WHERE p.o_orderstatus = 'P')
SELECT o_orderkey, CASE WHEN b - a <= 12 THEN b - a - 1 END AS places FROM n""",
    "labels_above": """WITH l AS (SELECT l_orderkey, l_partkey % 40 AS x, l_suppkey % 97 AS y, l_returnflag FROM lineitem)
SELECT g.l_orderkey, g.x, g.y, max(t.y) AS label FROM l g LEFT JOIN l t ON t.l_orderkey = g.l_orderkey AND t.l_returnflag = 'R' AND t.y < g.y AND abs(t.x - g.x) <= 10 WHERE g.l_returnflag = 'N' GROUP BY ALL""",
    "missing_candidates": """WITH o AS (SELECT *, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM orders), j AS (SELECT o_orderkey, CASE l_returnflag WHEN 'R' THEN 'rejected' ELSE 'near' END AS kind, l_linenumber::BIGINT AS line, l_partkey, l_suppkey FROM o JOIN lineitem ON l_orderkey = p WHERE o_orderstatus = 'P' AND l_returnflag IN ('R', 'A'))
SELECT o_orderkey, kind, line, l_partkey, row_number() OVER (PARTITION BY o_orderkey ORDER BY kind DESC, line, l_partkey, l_suppkey) AS r FROM j QUALIFY r <= 8""",
    "overriding_files": "SELECT p_name, coalesce(max(CASE WHEN p_size = 7 THEN p_partkey END), min(p_partkey)) AS file FROM part GROUP BY p_name",
    "feedback_corrections": """SELECT event_id, 0::BIGINT AS nth, CASE event_type WHEN 'purchase' THEN 'reject' WHEN 'signup' THEN 'not' ELSE 'assign' END AS action, CASE event_type WHEN 'purchase' THEN NULL WHEN 'error' THEN user_id + 1 ELSE user_id END AS target FROM events WHERE event_type IN ('click', 'purchase', 'signup', 'error')""",
    "dirty_blocks": "WITH e AS (SELECT * FROM events WHERE event_type = 'error' AND event_id % 40 = 0) SELECT event_id % 25 AS block FROM e UNION SELECT p_partkey % 25 FROM part WHERE p_partkey IN (SELECT user_id FROM e UNION SELECT user_id + 1 FROM e)",
    "adjusted_counts": f"WITH {_STATUS}, p AS (SELECT count(*) AS p FROM st WHERE status = 'inferred' AND l_linenumber = 2) SELECT status, count(*) + CASE status WHEN 'aligned' THEN any_value(p) WHEN 'inferred' THEN -any_value(p) ELSE 0 END AS n FROM st, p GROUP BY status",
    "ordered_lists": f"WITH {_ITEMS} SELECT block, string_agg(code, ' ' ORDER BY p_partkey) AS codes FROM i GROUP BY block",
    "merged_entries": """WITH l AS (SELECT c_nationkey::BIGINT AS nation, arg_min(c_mktsegment, c_custkey) AS first, arg_max(c_mktsegment, c_custkey) AS last FROM customer WHERE c_nationkey % 2 = 0 GROUP BY 1), r AS (SELECT n_nationkey::BIGINT AS nation, n_name FROM nation WHERE n_nationkey % 3 = 0)
SELECT coalesce(l.nation, r.nation) AS nation, first, last, coalesce(n_name, last) AS value FROM l FULL JOIN r ON l.nation = r.nation""",
    "held_out_accuracy": "SELECT round(avg(CASE WHEN (n_chars >= 300)::INT = quality THEN 1 ELSE 0 END), 6) AS accuracy, count(*) AS n FROM labels JOIN documents USING (doc_id)",
    "cleaned_positives": """WITH r AS (SELECT labels.doc_id, source, toxic::BIGINT AS toxic, labels.doc_id % 3 AS f FROM labels JOIN documents USING (doc_id)), s AS (SELECT r.doc_id, r.toxic, coalesce((SELECT avg(q.toxic::DOUBLE) FROM r q WHERE q.source IS NOT DISTINCT FROM r.source AND q.f <> r.f), 0) AS share FROM r)
SELECT doc_id, toxic, round(share, 6) AS share FROM s WHERE toxic <> 1 OR share >= 0.1::DOUBLE""",
    "half_neighbours": 'SELECT o_orderkey, coalesce(lag(o_orderkey) OVER w, o_orderkey) AS back, coalesce(lead(o_orderkey) OVER w, o_orderkey) AS "on" FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)',
    "book_order": "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '1-URGENT' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 99 END, o_orderkey) AS place FROM orders",
    "deep_page": "SELECT l_quantity, l_orderkey, l_partkey FROM lineitem ORDER BY l_quantity, l_orderkey, l_partkey LIMIT 120 OFFSET 4320",
    "last_page": "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 120 OFFSET (SELECT (greatest(count(*), 1) - 1) // 120 * 120 FROM customer)",
    "log_tails": "SELECT doc_id, right(coalesce(text, ''), 80) AS tail FROM documents",
    "character_classes": "WITH c AS (SELECT item_id, unnest(string_split(text, '')) AS ch FROM benchmark), k AS (SELECT item_id, CASE WHEN regexp_full_match(ch, '[a-m]') THEN 1 WHEN regexp_full_match(ch, '[n-z]') THEN 2 WHEN regexp_full_match(ch, '[0-9]') THEN 3 ELSE 4 END AS k FROM c) SELECT item_id::BIGINT AS item_id, count_if(k = 1)::BIGINT AS covered, count_if(k = 2)::BIGINT AS uncovered, count_if(k = 3)::BIGINT AS passed, count_if(k = 4)::BIGINT AS other FROM k GROUP BY item_id",
    "conversion_chain": f"SELECT item_id::BIGINT AS item_id, array_to_string(list_transform(string_split(text, ''), lambda c: CASE{_CHAIN} ELSE c END), '') AS converted FROM benchmark",
}
