"""Logs, overlays, dictionaries and work queues: queries over the star schema's tables."""

import functools
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella import session
from tessella.functions import scalars as S
from tessella.operators import lexicon as L
from tessella.operators import logs as G
from tessella.operators import overlay as O
from tessella.session import prepare, table

#: Event types as the verbs of a review log, and the corrections that they become; comments become none.
VERBS = {"click": "rebox", "view": "comment", "purchase": "reject", "signup": "delete", "logout": "locate"}
ACTIONS = {"rebox": "assign", "locate": "assign", "reject": "reject", "delete": "not"}


def status_classify(spark, sf_dir):
    """A similarity (the discount) against thresholds by kind (the return flag); forced rows (line status F and tax 0) are manual."""
    df = table(prepare(spark), sf_dir, "lineitem")
    sim, least = 1 - F.col("l_discount") * 5, F.when(F.col("l_returnflag") == "N", 0.65).otherwise(0.78)
    status = F.when((F.col("l_linestatus") == "F") & (F.col("l_tax") == 0), "manual").when(F.round(sim, 4) >= least, "aligned").otherwise("inferred")
    return df.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), status.alias("status"))


def status_summary(spark, sf_dir):
    return status_classify(spark, sf_dir).groupBy("status").agg(F.count("*").alias("n"), F.countDistinct("l_orderkey").alias("orders"))


def running_total(spark, sf_dir):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity").rowsBetween(Window.unboundedPreceding, 0)
    return table(prepare(spark), sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), S.r6(F.sum("l_quantity").over(w)).alias("total"))


def overlay_lww(spark, sf_dir):
    ev = table(prepare(spark), sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return O.last_writer(ev.withColumn("slot", F.col("event_id") % 7), ["user_id", "slot"], "event_id", "event_type", "value")


def feedback_to_actions(spark, sf_dir):
    ev = table(prepare(spark), sf_dir, "events").select("event_id", "user_id", "event_type")
    pick = lambda d, c: F.coalesce(*[F.when(c == k, v) for k, v in d.items()])
    df = ev.withColumn("verb", pick(VERBS, F.col("event_type"))).withColumn("action", pick(ACTIONS, F.col("verb"))).filter("action is not null")
    return df.select("event_id", "user_id", "action", F.when(F.col("action") != "reject", F.upper(F.lpad(F.conv("user_id", 10, 16), 5, "0"))).alias("target"))


def overlay_fold(spark, sf_dir):
    """The full fold: an order's lines are boxes, its lines of even number act on them in turn."""
    df = table(prepare(spark), sf_dir, "lineitem")
    x, y, w = F.col("l_partkey") % 40, F.col("l_suppkey") % 10, F.col("l_quantity").cast("long")
    box = df.select("l_orderkey", x.alias("x0"), y.alias("y0"), (x + w).alias("x1"), (y + 20).alias("y1"), F.col("l_linenumber").cast("long").alias("ord"), F.col("l_suppkey").alias("target"), "l_returnflag")
    verb = F.when(F.col("l_returnflag") == "N", "assign").when(F.col("l_returnflag") == "A", "reject").otherwise("not")
    return O.overlay(box.filter("ord % 2 = 1").select("l_orderkey", "x0", "y0", "x1", "y1"), box.filter("ord % 2 = 0").withColumn("action", verb), ["l_orderkey"]).drop("forbid")


def _ruled(spark, sf_dir):
    """An order is a page: lines 1, 4, 7, ... are its boxes, 2, 5, 8, ... its actions, the open ones of 3, 6, ... its locked rows; rules stand at even distances."""
    df = table(prepare(spark), sf_dir, "lineitem")
    x, y, w = F.col("l_partkey") % 40, F.col("l_suppkey") % 10, F.col("l_quantity").cast("long")
    verb = F.when(F.col("l_returnflag") == "A", "reject").when(F.col("l_returnflag") == "R", "not").when(F.col("l_linestatus") == "O", "assign").otherwise("add")
    line, target = F.col("l_linenumber").cast("long"), F.col("l_suppkey") % 4
    kind = F.when(F.col("l_quantity") > 25, "headword").otherwise("inline")
    df = df.select("l_orderkey", x.alias("x0"), y.alias("y0"), (x + w).alias("x1"), (y + 20).alias("y1"), line.alias("ord"), verb.alias("action"), F.when((verb != "add") | (F.col("l_suppkey") % 3 > 0), target).alias("target"), (F.col("l_partkey") % 5 + 1).alias("column"), kind.alias("kind"), "l_linestatus")
    rules = df.select("l_orderkey").distinct().withColumn("rules", F.transform(F.sequence(F.lit(0), F.lit(4)), lambda k: F.col("l_orderkey") % 7 + k * (8 + F.col("l_orderkey") % 5)))
    locked = df.filter("ord % 3 = 0 and l_linestatus = 'O'").select("l_orderkey", F.col("ord").alias("ident"), *O.BOX, F.coalesce("target", F.lit(0)).alias("target"))
    return O.ruled_pages(df.filter("ord % 3 = 1").select("l_orderkey", *O.BOX, "column", "kind"), df.filter("ord % 3 = 2").select("l_orderkey", "ord", "action", *O.BOX, "target"), rules, ["l_orderkey"], locked)


def overlay_ruled(spark, sf_dir):
    """The overlay with placement between rules, kinds and locked rows."""
    rows = O.ruled_rows(_ruled(spark, sf_dir), ["l_orderkey"])
    return rows.withColumn("forbid", F.array_join(F.transform("forbid", lambda x: x.cast("string")), ","))


def overlay_effects(spark, sf_dir):
    """Every action of the overlay, locked rows included, and whether it took effect."""
    return O.ruled_actions(_ruled(spark, sf_dir), ["l_orderkey"]).drop("ident")


def _orders(spark, sf_dir):
    o = table(prepare(spark), sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.year("o_orderdate").cast("long").alias("y"))


def slice_replace(spark, sf_dir):
    """New rows (finished orders, repriced) take the place of all rows of their customer and year."""
    o = _orders(spark, sf_dir)
    new = o.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.round(F.col("o_totalprice") * 2, 2))
    return O.replace_slice(o, new, ["o_custkey", "y"]).select("o_orderkey", "o_custkey", "y", S.r6(F.col("o_totalprice")).alias("price"))


def slice_sink(spark, sf_dir):
    """A table of orders by year in a folder, of which a second write replaces the odd years: their finished orders, repriced, read from the folder itself."""
    folder = f"{session.checkpoint_dir(spark)}/sink-{uuid.uuid4().hex}"
    try:
        o = _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price"), "y")
        G.write_slices(o, folder, ["y"])
        there = spark.read.schema(o.schema).parquet(folder)
        G.write_slices(there.filter("y % 2 = 1 and o_orderstatus = 'F'").withColumn("price", F.round(F.col("price") * 2, 2)), folder, ["y"])
        return spark.read.schema(o.schema).parquet(folder).withColumn("price", S.r6(F.col("price"))).checkpoint(eager=True)
    finally:
        session.remove(spark, folder)


def followed_log(spark, sf_dir):
    """Events that arrive in four files, every tenth of them twice, followed as a stream: the last entry of each user and slot, and how many entries of the log it has."""
    folder = f"{session.checkpoint_dir(prepare(spark))}/follow-{uuid.uuid4().hex}"
    try:
        ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", (F.col("event_id") % 7).alias("slot"))
        twice = ev.withColumn("copy", F.lit(0)).unionByName(ev.filter("event_id % 10 = 0").withColumn("copy", F.lit(1)))
        twice.repartitionByRange(4, F.xxhash64("event_id", "copy")).drop("copy").write.parquet(f"{folder}/in")
        stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        G.follow(stream, folder, ["event_id"], ["user_id", "slot"], "event_id", ["event_type", "value"]).awaitTermination()
        last = G.state(spark, folder, "user_id long, slot long, event_id long, event_type string, value double")
        n = G.log(spark, folder, "event_id long, user_id long, slot long").groupBy("user_id", "slot").agg(F.count("*").alias("n"))
        return last.join(n, ["user_id", "slot"]).select("user_id", "slot", "event_id", "event_type", "value", "n").checkpoint(eager=True)
    finally:
        session.remove(spark, folder)


def upsert_missing(spark, sf_dir):
    o = _orders(spark, sf_dir).select("y", "o_orderkey", "o_orderstatus")
    new = o.filter("o_orderstatus = 'P'").select("y", "o_orderkey", F.lit("new").alias("o_orderstatus"))
    return O.replace_slice(o.filter("o_orderstatus = 'O'"), new, ["y", "o_orderkey"])


def missing_range(spark, sf_dir):
    """Line keys order * 8 + line that an order's first to last possible line (1 to 7) lacks."""
    li = table(prepare(spark), sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("line"))
    wanted = li.select("l_orderkey").distinct().withColumn("line", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(7).cast("long"))))
    return wanted.join(li, ["l_orderkey", "line"], "left_anti")


def _gaps(keys, width=1000, levels=2):
    """start, end (half-open) of what is absent between present values of k: within ranges of `width` keys, then between the ranges' ends in the same way."""
    w = Window.partitionBy("b").orderBy("lo") if levels else Window.orderBy("lo")
    rows = keys.withColumn("b", F.floor(F.col("lo") / width))
    inside = rows.withColumn("next", F.lead("lo").over(w)).filter("next > hi + 1").select((F.col("hi") + 1).alias("start"), F.col("next").alias("end"))
    if not levels:
        return inside
    return inside.unionByName(_gaps(rows.groupBy("b").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")), width * 1000, levels - 1))


def page_gaps(spark, sf_dir):
    """Half-open ranges of document ids without a label between those with one."""
    k = table(prepare(spark), sf_dir, "labels").select(F.col("doc_id").alias("lo"), F.col("doc_id").alias("hi")).distinct()
    return _gaps(k)


def dup_keys(spark, sf_dir):
    d = table(prepare(spark), sf_dir, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    return d.groupBy("h").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).filter("n > 1").select("first_id", "last_id", "n")


def rule_violations(spark, sf_dir):
    """Rows of (rule, key, detail) for a few constraints; one scan of each table."""
    c, s = table(prepare(spark), sf_dir, "customer"), table(spark, sf_dir, "supplier")
    rules = {"name_syntax": ~F.col("c_name").rlike("^Customer#[0-9]{9}$"), "balance_range": ~F.col("c_acctbal").between(-900, 9900), "segment_known": ~F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "AUTOMOBILE")}
    found = F.filter(F.array(*[F.when(bad, F.lit(r)) for r, bad in rules.items()]), lambda x: x.isNotNull())
    a = c.select(F.explode(found).alias("rule"), F.col("c_custkey").alias("key"), F.col("c_name").alias("detail"))
    b = s.groupBy("s_nationkey").agg(F.count("*").alias("n")).filter("n > 5").select(F.lit("too_many_suppliers").alias("rule"), F.col("s_nationkey").cast("long").alias("key"), F.col("n").cast("string").alias("detail"))
    return a.unionByName(b)


def eav_pivot(spark, sf_dir):
    l = table(prepare(spark), sf_dir, "labels")
    long = l.select("doc_id", F.explode(F.create_map(F.lit("quality"), F.col("quality").cast("long"), F.lit("toxic"), F.col("toxic").cast("long"))).alias("property", "value"))
    return long.groupBy("doc_id").pivot("property", ["quality", "toxic"]).agg(F.first("value"))


def first_by_order(spark, sf_dir):
    p = table(prepare(spark), sf_dir, "part").select("p_brand", "p_partkey", "p_name", "p_retailprice")
    return O.first_of_group(p, ["p_brand"], F.struct((-F.col("p_retailprice")).alias("k"), "p_partkey"), "p_partkey", "p_name")


def min_with_override(spark, sf_dir):
    """The first customer of each nation, but the richest one's nation group prefers its smallest key over 100; nation 99 comes from the preferences alone."""
    c = table(prepare(spark), sf_dir, "customer").select(F.col("c_nationkey").cast("long").alias("nation"), "c_custkey", "c_mktsegment")
    prefer = c.filter("c_mktsegment = 'BUILDING' and c_custkey > 100").select(F.when(F.col("nation") == 7, 99).otherwise(F.col("nation")).cast("long").alias("nation"), "c_custkey")
    return L.min_with_override(c.select("nation", "c_custkey"), prefer, "nation", "c_custkey")


def invert_multivalue(spark, sf_dir):
    return L.invert(table(prepare(spark), sf_dir, "part"), "p_partkey", "p_type")


def invert_pairs(spark, sf_dir):
    """The whole inverted index."""
    return L.pairs(table(prepare(spark), sf_dir, "part"), "p_partkey", "p_type").select("value", F.col("k").alias("p_partkey"))


CONVERT = {"th": "T", "the": "D", "he": "H", "an": "A", "and": "&", "in": "I", "ing": "G", "er": "R", "o": "0"}


def greedy_convert(spark, sf_dir):
    b = table(prepare(spark), sf_dir, "benchmark").select("item_id", "text")
    return b.select("item_id", L.longest_match(F.col("text"), CONVERT, 3).alias("converted"))


def greedy_convert_whole(spark, sf_dir):
    """greedy_convert by a trie over batches of texts."""
    b = table(prepare(spark), sf_dir, "benchmark").select("item_id", "text")
    return L.convert_broadcast(b, "text", CONVERT, "converted").select("item_id", "converted")


def _dictionaries(spark, sf_dir):
    """Lines of four dictionaries from the words of the texts, each in the order of its words: characters, phrases, variants, and one that is read the other way."""
    words = table(prepare(spark), sf_dir, "benchmark").select(F.explode(F.split("text", "[^A-Za-z]+")).alias("n")).filter("length(n) >= 5").distinct()
    w, tab = F.col("n"), F.lit("\t")
    cut = lambda a, n: F.substring(w, a, n)
    lines = {
        "characters": F.when(w.startswith("w"), F.concat(F.lit("# "), w)).when(w.startswith("s"), w).otherwise(F.concat(cut(1, 2), tab, F.upper(cut(3, 2)), F.lit(" "), cut(1, 1))),
        "phrases": F.when(w < "n", F.concat(cut(1, 4), tab, F.reverse(cut(1, 4)))),
        "variants": F.concat(F.upper(cut(3, 2)), tab, cut(3, 2), F.lit("+ ?")),
        "reversed": F.when(w.startswith("t"), F.concat(F.lit("# @reverse-prefer: "), cut(2, 3), F.lit(" <"), cut(1, 2), F.lit(">"))).otherwise(F.concat(cut(1, 3), tab, cut(2, 2), F.lit(" "), cut(2, 3))),
    }
    return {k: words.select("n", c.alias("line")).filter("line is not null") for k, c in lines.items()}


def convert_dictionaries(spark, sf_dir):
    """A chain of three conversions: characters with phrases over them, variants, and a reversed dictionary."""
    d = _dictionaries(spark, sf_dir)
    stages = [L.merged(L.dictionary(d["characters"]), L.dictionary(d["phrases"])), L.dictionary(d["variants"]), L.reversed_dictionary(d["reversed"])]
    b = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return L.convert_chain(b, "text", stages, "converted").select("item_id", "converted")


def converted_lengths(spark, sf_dir):
    """Texts whose number of characters the chain of conversions changes, so that what goes with their characters one by one would drift."""
    both = convert_dictionaries(spark, sf_dir).join(table(spark, sf_dir, "benchmark").select("item_id", "text"), "item_id")
    return both.select("item_id", F.length("text").cast("long").alias("before"), F.length("converted").cast("long").alias("after"), (F.length("text") != F.length("converted")).alias("drifts"))


def dictionary_entries(spark, sf_dir):
    """What the dictionaries' lines say, by dictionary."""
    d = _dictionaries(spark, sf_dir)
    out = [L.dictionary(d[k]).withColumn("name", F.lit(k)) for k in ("characters", "phrases", "variants")] + [L.reversed_dictionary(d["reversed"]).withColumn("name", F.lit("reversed"))]
    return functools.reduce(DataFrame.unionByName, out)


def resolve_lookup(spark, sf_dir):
    part = table(prepare(spark), sf_dir, "part").select("p_partkey", "p_name", "p_size")
    wanted = part.select(F.element_at(F.split("p_name", " "), -1).alias("word")).union(part.filter("p_size = 1").select(F.concat(F.lit("no"), F.element_at(F.split("p_name", " "), 1)))).distinct()
    return L.resolve(wanted, part, "word", "p_partkey", "p_name")


def char_class_counts(spark, sf_dir):
    classes = {"digits": "0-9", "latin": "A-Za-z", "accented": "\\u00C0-\\u024F", "blanks": " \\n\\t"}
    d = table(prepare(spark), sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return d.select("doc_id", *L.class_counts(F.col("text"), classes), F.length("text").cast("long").alias("chars"))


def slugify_url(spark, sf_dir):
    return table(prepare(spark), sf_dir, "pages").select("page_id", S.slugify(F.col("url")).alias("slug"))


def padded_keys(spark, sf_dir):
    p = table(prepare(spark), sf_dir, "part")
    return p.select("p_partkey", F.format_string("p%04d-w%d", F.col("p_partkey"), F.col("p_size")).alias("page_key"), S.hex5(F.col("p_partkey")).alias("hex_key"), S.code_point(S.hex5(F.col("p_partkey"))).cast("long").alias("back"))


def page_range(spark, sf_dir):
    """A list like `7-20,45` for each part, expanded and without repeats."""
    p = table(prepare(spark), sf_dir, "part").select("p_partkey", F.concat(F.col("p_size").cast("string"), F.lit("-"), (F.col("p_size") + F.col("p_partkey") % 5).cast("string"), F.lit(","), (F.col("p_size") + 2).cast("string")).alias("pages"))
    ends = p.select("p_partkey", F.explode(F.split("pages", ",")).alias("r")).withColumn("b", F.split("r", "-"))
    return ends.select("p_partkey", F.explode(F.sequence(F.element_at("b", 1).cast("long"), F.element_at("b", -1).cast("long"))).alias("page")).distinct()


def half_expansion(spark, sf_dir):
    """Each order's date range as (day, side) rows in reading order, right before left, without the first right and the last left of odd orders."""
    o = table(prepare(spark), sf_dir, "orders").select("o_orderkey", (F.dayofyear("o_orderdate") % 4).cast("int").alias("n"))
    halves = o.select("o_orderkey", "n", F.explode(F.sequence(F.lit(0), "n")).alias("day")).withColumn("side", F.explode(F.array(F.lit("right"), F.lit("left"))))
    odd = F.col("o_orderkey") % 2 == 1
    halves = halves.filter(~(odd & (F.col("day") == 0) & (F.col("side") == "right")) & ~(odd & (F.col("day") == F.col("n")) & (F.col("side") == "left")))
    w = Window.partitionBy("o_orderkey").orderBy("day", F.col("side").desc())
    return halves.select("o_orderkey", F.col("day").cast("long").alias("day"), "side", F.row_number().over(w).cast("long").alias("ord"))


def topk_per_group(spark, sf_dir):
    c = table(prepare(spark), sf_dir, "customer").select(F.col("c_nationkey").cast("long").alias("nation"), "c_custkey", "c_acctbal")
    w = Window.partitionBy("nation").orderBy(F.col("c_acctbal").desc(), "c_custkey")
    return c.withColumn("r", F.row_number().over(w).cast("long")).filter("r <= 8")


def page_worst_first(spark, sf_dir):
    """The second page of 120 of the customers, lowest balance first: sorted top rows, not a full ranking."""
    c = table(prepare(spark), sf_dir, "customer").select("c_custkey", "c_acctbal")
    return c.orderBy("c_acctbal", "c_custkey").offset(120).limit(120)


def fingerprint_diff(spark, sf_dir):
    o = _orders(spark, sf_dir)
    mark = lambda df: df.select("o_orderkey", F.sha2(F.concat_ws("|", F.col("o_orderstatus"), F.col("o_custkey").cast("string")), 256).alias("fp"))
    old = mark(o.filter("o_orderkey % 11 <> 0"))
    new = mark(o.filter("o_orderkey % 13 <> 0").withColumn("o_custkey", F.when(F.col("o_orderstatus") == "P", F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))))
    return O.snapshot_diff(old, new, "o_orderkey", "fp")


def unused_rules(spark, sf_dir):
    """Nations that no supplier of positive balance has used."""
    n, s = table(prepare(spark), sf_dir, "nation"), table(spark, sf_dir, "supplier")
    return n.join(s.filter("s_acctbal > 5000"), F.col("n_nationkey") == F.col("s_nationkey"), "left_anti").select(F.col("n_nationkey").cast("long").alias("nation"), "n_name")


def radical_check(spark, sf_dir):
    """Expected against found counts by group: lines that an order should have (its priority's digit) and has."""
    o, l = table(prepare(spark), sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    found = l.groupBy("l_orderkey").agg(F.count("*").alias("found"))
    want = o.select("o_orderkey", F.left("o_orderpriority", F.lit(1)).cast("long").alias("expected"))
    j = want.join(found, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return j.select("o_orderkey", "expected", "found", F.when(F.col("expected") == F.col("found"), "ok").otherwise("CONFLICT").alias("state"))


QUERIES = {f.__name__: f for f in (
    status_classify, status_summary, running_total, overlay_lww, feedback_to_actions, overlay_fold, overlay_ruled, overlay_effects, slice_replace, slice_sink, followed_log, upsert_missing, missing_range, page_gaps, dup_keys, rule_violations, eav_pivot, first_by_order, min_with_override,
    invert_multivalue, invert_pairs, greedy_convert, greedy_convert_whole, convert_dictionaries, converted_lengths, dictionary_entries, resolve_lookup, char_class_counts, slugify_url, padded_keys, page_range, half_expansion, topk_per_group, page_worst_first, fingerprint_diff, unused_rules, radical_check,
)}

_STATUS = "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CASE WHEN l_linestatus = 'F' AND l_tax = 0 THEN 'manual' WHEN round(1 - l_discount * 5, 4) >= CASE WHEN l_returnflag = 'N' THEN 0.65::DOUBLE ELSE 0.78::DOUBLE END THEN 'aligned' ELSE 'inferred' END AS status FROM lineitem"
_Y = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, year(o_orderdate) AS y FROM orders"
_WHEN = lambda d, c: "CASE " + " ".join(f"WHEN {c} = '{k}' THEN '{v}'" for k, v in d.items()) + " END"

_GREEDY = f"""WITH RECURSIVE m AS (SELECT map([{', '.join(f"'{k}'" for k in CONVERT)}], [{', '.join(f"'{v}'" for v in CONVERT.values())}]) AS d), b AS (SELECT item_id, text AS t FROM benchmark),
s AS (SELECT item_id, t, 1 AS p, '' AS o FROM b UNION ALL SELECT item_id, t, p + n, o || CASE WHEN v IS NULL THEN t[p:p] ELSE v END FROM (SELECT s.*,
CASE WHEN p + 2 <= length(t) AND d[t[p:p+2]] IS NOT NULL THEN 3 WHEN p + 1 <= length(t) AND d[t[p:p+1]] IS NOT NULL THEN 2 ELSE 1 END AS n,
CASE WHEN p + 2 <= length(t) AND d[t[p:p+2]] IS NOT NULL THEN d[t[p:p+2]] WHEN p + 1 <= length(t) AND d[t[p:p+1]] IS NOT NULL THEN d[t[p:p+1]] ELSE d[t[p:p]] END AS v FROM s, m WHERE p <= length(t)))
SELECT item_id, o AS converted FROM s WHERE p > length(t)"""
# what dictionary lines say: the last line of a key; read the other way the first key of a value, preferences before it
_LEXICON = """w AS (SELECT DISTINCT unnest(regexp_split_to_array(text, '[^A-Za-z]+')) AS n FROM benchmark),
l AS (SELECT 'characters' AS name, n, CASE WHEN n LIKE 'w%' THEN '# ' || n WHEN n LIKE 's%' THEN n ELSE n[1:2] || chr(9) || upper(n[3:4]) || ' ' || n[1:1] END AS line FROM w WHERE length(n) >= 5
 UNION ALL SELECT 'phrases', n, n[1:4] || chr(9) || reverse(n[1:4]) FROM w WHERE length(n) >= 5 AND n < 'n'
 UNION ALL SELECT 'variants', n, upper(n[3:4]) || chr(9) || n[3:4] || '+ ?' FROM w WHERE length(n) >= 5
 UNION ALL SELECT 'reversed', n, CASE WHEN n LIKE 't%' THEN '# @reverse-prefer: ' || n[2:4] || ' <' || n[1:2] || '>' ELSE n[1:3] || chr(9) || n[2:3] || ' ' || n[2:4] END FROM w WHERE length(n) >= 5),
x AS (SELECT name, n, split_part(line, chr(9), 1) AS k, string_split(split_part(line, chr(9), 2), ' ') AS v FROM l WHERE line NOT LIKE '#%' AND contains(line, chr(9))),
f AS (SELECT v AS key, min_by(k, n) AS k FROM (SELECT n, k, unnest(v) AS v FROM x WHERE name = 'reversed') GROUP BY v),
g AS (SELECT split_part(line, ' ', 3) AS key, max_by(split_part(line, ' ', 4), n) AS k FROM l WHERE line LIKE '# @reverse-prefer:%' GROUP BY 1),
entries AS (SELECT name, k AS key, max_by(v[1], n) AS value FROM x WHERE name <> 'reversed' GROUP BY name, k
 UNION ALL SELECT 'reversed', coalesce(f.key, g.key), coalesce(g.k, f.k) FROM f FULL JOIN g ON f.key = g.key)"""
_BOXES = "SELECT l_orderkey AS p, l_linenumber::BIGINT AS ord, l_partkey % 40 AS x0, l_suppkey % 10 AS y0, l_partkey % 40 + l_quantity::BIGINT AS x1, l_suppkey % 10 + 20 AS y1, * FROM lineitem"
_BOTH = "(greatest(least(r.x1, a.x1) - greatest(r.x0, a.x0), 0) * greatest(least(r.y1, a.y1) - greatest(r.y0, a.y0), 0))"
_IOU = f"({_BOTH}::DOUBLE / greatest((r.x1 - r.x0) * (r.y1 - r.y0) + (a.x1 - a.x0) * (a.y1 - a.y0) - {_BOTH}, 1))"
_SEAL = "{{'x0': {0}.x0, 'y0': {0}.y0, 'x1': {0}.x1, 'y1': {0}.y1, 'column': {column}, 'kind': {kind}, 'target': {target}, 'forbid': {forbid}, 'locked': {locked}}}"
# one action after the other over each page's list of rows
_RULED = f"""WITH RECURSIVE b AS (SELECT p, ord, x0, y0, x1, y1, l_partkey % 5 + 1 AS "column", CASE WHEN l_quantity > 25 THEN 'headword' ELSE 'inline' END AS kind, l_linestatus,
 CASE WHEN l_returnflag = 'A' THEN 'reject' WHEN l_returnflag = 'R' THEN 'not' WHEN l_linestatus = 'O' THEN 'assign' ELSE 'add' END AS action, l_suppkey FROM ({_BOXES})),
t AS (SELECT *, CASE WHEN action <> 'add' OR l_suppkey % 3 > 0 THEN l_suppkey % 4 END AS target FROM b),
u AS (SELECT p, 1 AS part, ord, x0, y0, x1, y1, action, target, NULL::BIGINT AS ident FROM t WHERE ord % 3 = 2
 UNION ALL SELECT p, 2, NULL, x0, y0, x1, y1, 'locked', coalesce(target, 0), ord FROM t WHERE ord % 3 = 0 AND l_linestatus = 'O'),
acts AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY part, ord, y0, x0, y1, x1, action, target NULLS FIRST, ident) AS n FROM u),
pages AS (SELECT DISTINCT p FROM (SELECT p FROM t WHERE ord % 3 = 1 UNION ALL SELECT p FROM acts)),
start AS (SELECT p, list({_SEAL.format('t', column='t."column"', kind='t.kind', target='NULL::BIGINT', forbid='[]::BIGINT[]', locked='NULL::BIGINT')} ORDER BY y0, x0, y1, x1, "column", kind) AS rows FROM t WHERE ord % 3 = 1 GROUP BY p),
st AS (SELECT p, 0::BIGINT AS n, coalesce(rows, []) AS rows, []::BIGINT[] AS used FROM pages LEFT JOIN start USING (p)
UNION ALL
SELECT p, n, CASE
 WHEN a.action = 'not' THEN list_transform(rows, lambda r: CASE WHEN {_IOU} > 0.5 THEN {_SEAL.format('r', column='r."column"', kind='r.kind', target='CASE WHEN r.target IS DISTINCT FROM a.target THEN r.target END', forbid='list_append(r.forbid, a.target)', locked='r.locked')} ELSE r END)
 WHEN a.action = 'reject' THEN list_filter(rows, lambda r: {_IOU} <= 0.5)
 WHEN a.target IS NOT NULL THEN list_transform(CASE WHEN hit > 0 THEN list_transform(rows, lambda r, i: CASE WHEN i = hit THEN {_SEAL.format('a', column='r."column"', kind='made', target='a.target', forbid='r.forbid', locked='r.locked')} ELSE r END)
  WHEN col IS NOT NULL THEN list_append(rows, {_SEAL.format('a', column='col', kind='made', target='a.target', forbid='[]::BIGINT[]', locked='NULL::BIGINT')}) ELSE rows END,
  lambda r: CASE WHEN a.action = 'locked' AND r.kind = 'approved' AND r.target = a.target THEN {_SEAL.format('r', column='r."column"', kind='r.kind', target='r.target', forbid='r.forbid', locked='a.ident')} ELSE r END)
 WHEN a.action = 'add' AND met = 0 AND col IS NOT NULL THEN list_append(rows, {_SEAL.format('a', column='col', kind='made', target='NULL::BIGINT', forbid='[]::BIGINT[]', locked='NULL::BIGINT')}) ELSE rows END,
 CASE WHEN CASE WHEN a.action IN ('not', 'reject') THEN met > 0 WHEN a.target IS NOT NULL THEN hit > 0 OR col IS NOT NULL ELSE a.action = 'add' AND met = 0 AND col IS NOT NULL END THEN list_append(used, n) ELSE used END
FROM (SELECT st.p, acts.n, st.rows, st.used, acts AS a, CASE WHEN acts.action = 'locked' THEN 'approved' ELSE 'manual' END AS made,
  coalesce(list_position(list_transform(st.rows, lambda r: {_IOU.replace("a.", "acts.")} > 0.3), true), 0) AS hit, len(list_filter(st.rows, lambda r: {_IOU.replace("a.", "acts.")} > 0.5)) AS met,
  list_max(list_transform(range(4), lambda c: CASE WHEN st.p % 7 + c * (8 + st.p % 5) <= (acts.x0 + acts.x1) / 2 AND (acts.x0 + acts.x1) / 2 < st.p % 7 + (c + 1) * (8 + st.p % 5) THEN 4 - c END)) AS col
  FROM st JOIN acts ON acts.p = st.p AND acts.n = st.n + 1)),
ends AS (SELECT p, max(n) AS n FROM st GROUP BY p), done AS (SELECT st.* FROM st JOIN ends USING (p, n))"""

ORACLE_SQL = {
    "overlay_ruled": f"""{_RULED}, r AS (SELECT p, unnest(rows) AS r FROM done)
SELECT p AS l_orderkey, r.x0, r.y0, r.x1, r.y1, r."column", r.kind, r.target, array_to_string(r.forbid, ',') AS forbid, r.locked FROM r""",
    "overlay_effects": f"{_RULED} SELECT acts.p AS l_orderkey, acts.n, ord, action, x0, y0, x1, y1, target, list_contains(used, acts.n) AS used FROM acts JOIN done ON done.p = acts.p",
    "overlay_fold": f"""WITH RECURSIVE b AS (SELECT *, l_suppkey AS target, CASE l_returnflag WHEN 'N' THEN 'assign' WHEN 'A' THEN 'reject' ELSE 'not' END AS action FROM ({_BOXES})),
acts AS (SELECT p, x0, y0, x1, y1, action, target, row_number() OVER (PARTITION BY p ORDER BY ord, y0, x0, y1, x1, action, target) AS n FROM b WHERE ord % 2 = 0),
st AS (SELECT p, 0::BIGINT AS n, coalesce(list({{'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1, 'target': NULL::BIGINT}} ORDER BY y0, x0, y1, x1) FILTER (ord % 2 = 1), []) AS rows FROM b GROUP BY p
UNION ALL
SELECT p, n, CASE WHEN a.action = 'not' THEN list_transform(rows, lambda r: {{'x0': r.x0, 'y0': r.y0, 'x1': r.x1, 'y1': r.y1, 'target': CASE WHEN {_IOU} <= 0.5 OR r.target IS DISTINCT FROM a.target THEN r.target END}})
 WHEN a.action = 'reject' THEN list_filter(rows, lambda r: {_IOU} <= 0.5)
 WHEN hit > 0 THEN list_transform(rows, lambda r, i: CASE WHEN i = hit THEN {{'x0': a.x0, 'y0': a.y0, 'x1': a.x1, 'y1': a.y1, 'target': a.target}} ELSE r END)
 ELSE list_append(rows, {{'x0': a.x0, 'y0': a.y0, 'x1': a.x1, 'y1': a.y1, 'target': a.target}}) END
FROM (SELECT st.p, acts.n, st.rows, acts AS a, coalesce(list_position(list_transform(st.rows, lambda r: {_IOU.replace("a.", "acts.")} > 0.3), true), 0) AS hit FROM st JOIN acts ON acts.p = st.p AND acts.n = st.n + 1)),
ends AS (SELECT p, max(n) AS n FROM st GROUP BY p), done AS (SELECT st.p, unnest(st.rows) AS r FROM st JOIN ends USING (p, n))
SELECT p AS l_orderkey, r.x0, r.y0, r.x1, r.y1, r.target FROM done""",
    "status_classify": _STATUS,
    "status_summary": f"SELECT status, count(*) AS n, count(DISTINCT l_orderkey) AS orders FROM ({_STATUS}) GROUP BY status",
    "running_total": "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, round(sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity ROWS UNBOUNDED PRECEDING), 6) AS total FROM lineitem",
    "overlay_lww": "SELECT user_id, event_id % 7 AS slot, max_by(event_type, event_id) AS event_type, max_by(value, event_id) AS value FROM events GROUP BY ALL",
    "feedback_to_actions": f"WITH v AS (SELECT *, {_WHEN(VERBS, 'event_type')} AS verb FROM events), a AS (SELECT *, {_WHEN(ACTIONS, 'verb')} AS action FROM v) SELECT event_id, user_id, action, CASE WHEN action <> 'reject' THEN printf('%05X', user_id) END AS target FROM a WHERE action IS NOT NULL",
    "slice_replace": f"WITH o AS ({_Y}), n AS (SELECT o_orderkey, o_custkey, y, round(o_totalprice * 2, 2) AS price FROM o WHERE o_orderstatus = 'F') SELECT * FROM n UNION ALL SELECT o_orderkey, o_custkey, y, round(o_totalprice, 6) FROM o WHERE NOT EXISTS (FROM n WHERE n.o_custkey = o.o_custkey AND n.y = o.y)",
    "slice_sink": f"WITH o AS ({_Y}) SELECT o_orderkey, o_orderstatus, round(CASE WHEN y % 2 = 1 THEN round(o_totalprice * 2, 2) ELSE o_totalprice END, 6) AS price, y FROM o WHERE y % 2 = 0 OR o_orderstatus = 'F'",
    "followed_log": "SELECT user_id, event_id % 7 AS slot, max(event_id) AS event_id, max_by(event_type, event_id) AS event_type, max_by(value, event_id) AS value, count(*) AS n FROM events GROUP BY ALL",
    "upsert_missing": f"WITH o AS ({_Y}) SELECT y, o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'new' ELSE 'O' END AS o_orderstatus FROM o WHERE o_orderstatus IN ('O', 'P')",
    "missing_range": "SELECT l_orderkey, line FROM (SELECT DISTINCT l_orderkey FROM lineitem), range(1, 8) t(line) EXCEPT SELECT l_orderkey, l_linenumber FROM lineitem",
    "page_gaps": "WITH n AS (SELECT k, lead(k) OVER (ORDER BY k) AS x FROM (SELECT DISTINCT doc_id AS k FROM labels)) SELECT k + 1 AS start, x AS \"end\" FROM n WHERE x > k + 1",
    "dup_keys": "SELECT min(doc_id) AS first_id, max(doc_id) AS last_id, count(*) AS n FROM documents GROUP BY coalesce(text, '') HAVING count(*) > 1",
    "rule_violations": """SELECT 'name_syntax' AS rule, c_custkey AS key, c_name AS detail FROM customer WHERE NOT regexp_full_match(c_name, 'Customer#[0-9]{9}') UNION ALL SELECT 'balance_range', c_custkey, c_name FROM customer WHERE c_acctbal NOT BETWEEN -900 AND 9900
UNION ALL SELECT 'segment_known', c_custkey, c_name FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') UNION ALL SELECT 'too_many_suppliers', s_nationkey, count(*)::VARCHAR FROM supplier GROUP BY s_nationkey HAVING count(*) > 5""",
    "eav_pivot": "SELECT doc_id, first(quality)::BIGINT AS quality, first(toxic)::BIGINT AS toxic FROM labels GROUP BY doc_id",
    "first_by_order": "SELECT p_brand, p_partkey, p_name FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS r FROM part) WHERE r = 1",
    "min_with_override": "WITH w AS (SELECT CASE WHEN c_nationkey = 7 THEN 99 ELSE c_nationkey END AS nation, min(c_custkey) AS k FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey > 100 GROUP BY 1), l AS (SELECT c_nationkey AS nation, min(c_custkey) AS k FROM customer GROUP BY 1) SELECT coalesce(w.nation, l.nation)::BIGINT AS nation, coalesce(w.k, l.k) AS c_custkey FROM l FULL JOIN w ON l.nation = w.nation",
    "invert_multivalue": "SELECT value, count(DISTINCT p_partkey) AS n_keys, min(p_partkey) AS first_key FROM (SELECT p_partkey, unnest(string_split(p_type, ' ')) AS value FROM part) WHERE value <> '' GROUP BY value",
    "invert_pairs": "SELECT DISTINCT value, p_partkey FROM (SELECT p_partkey, unnest(string_split(p_type, ' ')) AS value FROM part) WHERE value <> ''",
    "dictionary_entries": f"WITH RECURSIVE {_LEXICON} SELECT name, key, value FROM entries",
    "convert_dictionaries": f"""WITH RECURSIVE {_LEXICON},
e AS (SELECT 1 AS stage, key, value FROM entries WHERE name = 'phrases' UNION ALL SELECT 1, key, value FROM entries c WHERE name = 'characters' AND NOT EXISTS (FROM entries p WHERE p.name = 'phrases' AND p.key = c.key)
 UNION ALL SELECT 2, key, value FROM entries WHERE name = 'variants' UNION ALL SELECT 3, key, value FROM entries WHERE name = 'reversed'),
d AS MATERIALIZED (SELECT stage, map(list(key ORDER BY key), list(value ORDER BY key)) AS m FROM e GROUP BY stage),
s AS (SELECT item_id, 1 AS stage, text AS t, 1 AS p, '' AS o FROM benchmark
UNION ALL
SELECT item_id, CASE WHEN p > length(t) THEN stage + 1 ELSE stage END, CASE WHEN p > length(t) THEN o ELSE t END, CASE WHEN p > length(t) THEN 1 ELSE p + n END, CASE WHEN p > length(t) THEN '' ELSE o || coalesce(m[t[p:p + n - 1]], t[p:p]) END
FROM (SELECT s.*, m, coalesce(list_max(list_filter([1, 2, 3, 4], lambda n: p + n - 1 <= length(t) AND m[t[p:p + n - 1]] IS NOT NULL)), 1) AS n FROM s JOIN d USING (stage)))
SELECT item_id, t AS converted FROM s WHERE stage = 4""",
    "greedy_convert": _GREEDY,
    "greedy_convert_whole": _GREEDY,
    "resolve_lookup": """WITH w AS (SELECT DISTINCT string_split(p_name, ' ')[-1] AS word FROM part UNION SELECT DISTINCT 'no' || string_split(p_name, ' ')[1] FROM part WHERE p_size = 1),
x AS (SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS v FROM part)
SELECT word, count(p_partkey) AS n, min(p_partkey) AS first_id, CASE count(p_partkey) WHEN 0 THEN 'none' WHEN 1 THEN 'one' ELSE 'many' END AS outcome FROM w LEFT JOIN x ON v = word GROUP BY word""",
    "char_class_counts": "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents) SELECT doc_id, " + ", ".join(f"length(t) - length(regexp_replace(t, '[{c}]', '', 'g')) AS {k}" for k, c in {"digits": "0-9", "latin": "A-Za-z", "accented": "\\x{00C0}-\\x{024F}", "blanks": " \\n\\t"}.items()) + ", length(t) AS chars FROM d",
    "slugify_url": r"SELECT page_id, left(regexp_replace(regexp_replace(regexp_replace(regexp_replace(url, '^[^:]*:', ''), '(?i)\.(pdf|djvu)$', ''), '[^\p{L}\p{N}_-]+', '_', 'g'), '^_+|_+$', '', 'g'), 80) AS slug FROM pages",
    "padded_keys": "SELECT p_partkey, printf('p%04d-w%d', p_partkey, p_size) AS page_key, printf('%05X', p_partkey) AS hex_key, p_partkey AS back FROM part",
    "page_range": "SELECT DISTINCT p_partkey, page FROM (SELECT p_partkey, unnest(list_append(range(p_size, p_size + p_partkey % 5 + 1), p_size + 2)) AS page FROM part)",
    "half_expansion": """WITH o AS (SELECT o_orderkey, dayofyear(o_orderdate) % 4 AS n FROM orders), h AS (SELECT o_orderkey, n, unnest(range(0, n + 1)) AS day FROM o), s AS (SELECT h.*, side FROM h, (VALUES ('right'), ('left')) v(side) WHERE o_orderkey % 2 = 0 OR NOT (day = 0 AND side = 'right') AND NOT (day = n AND side = 'left'))
SELECT o_orderkey, day, side, row_number() OVER (PARTITION BY o_orderkey ORDER BY day, side DESC) AS ord FROM s""",
    "topk_per_group": "SELECT c_nationkey::BIGINT AS nation, c_custkey, c_acctbal, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS r FROM customer QUALIFY r <= 8",
    "page_worst_first": "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 120 OFFSET 120",
    "fingerprint_diff": """WITH a AS (SELECT o_orderkey, o_orderstatus, o_custkey FROM orders WHERE o_orderkey % 11 <> 0), b AS (SELECT o_orderkey, o_orderstatus, o_custkey + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS o_custkey FROM orders WHERE o_orderkey % 13 <> 0)
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'orphan' WHEN a.o_orderkey IS NULL THEN 'added' WHEN a.o_custkey = b.o_custkey THEN 'unchanged' ELSE 'changed' END AS status FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey""",
    "unused_rules": "SELECT n_nationkey::BIGINT AS nation, n_name FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)",
    "radical_check": "WITH w AS (SELECT o_orderkey, left(o_orderpriority, 1)::BIGINT AS expected, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS found FROM orders) SELECT *, CASE WHEN expected = found THEN 'ok' ELSE 'CONFLICT' END AS state FROM w",
}
ORACLE_SQL["converted_lengths"] = f"SELECT item_id, length(text) AS before, length(converted) AS after, length(text) <> length(converted) AS drifts FROM ({ORACLE_SQL['convert_dictionaries']}) JOIN benchmark USING (item_id)"
