"""A reviewer's work list: what is shown of every item, by filter; missing items with what stands before them; half pages; and the state as one line of JSON a thing."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FIELDS = ["codepoint", "sequence", "title", "page", "side", "x", "y", "w", "h", "kind", "similarity", "status", "juan", "radical"]
HALF = ["title", "page", "side"]
#: What an event makes of its box: the correction and the column with its code point.
ACTIONS = {"delete": ("not", "codepoint"), "reject": ("reject", None), "rebox": ("assign", "codepoint"), "locate": ("assign", "codepoint"), "reassign": ("assign", "new_codepoint")}


def glyphs(rows: DataFrame, approved: DataFrame, modern: DataFrame, drawn: DataFrame, common: Column) -> DataFrame:
    """FIELDS of the rows with a code point, approved at once where the code point is in approved(codepoint), and modern ('' where modern(codepoint, modern) has
    none), common (by an expression over modern) and has_glyph (in drawn(codepoint))."""
    marked = lambda df, c: df.select("codepoint").distinct().withColumn(c, F.lit(True))
    out = rows.filter("codepoint <> ''").join(marked(approved, "ok_"), "codepoint", "left").join(modern.select("codepoint", "modern"), "codepoint", "left").join(marked(drawn, "drawn_"), "codepoint", "left")
    out = out.withColumn("status", F.when(F.col("ok_"), "approved").otherwise(F.col("status"))).withColumn("modern", F.coalesce("modern", F.lit("")))
    return out.select(*FIELDS, "modern", common.alias("common"), F.coalesce("drawn_", F.lit(False)).alias("has_glyph"))


def missing_items(wanted: DataFrame, found: DataFrame, order: str) -> DataFrame:
    """wanted(codepoint, juan, order) without a found item, and codepoint, page, side and title of the nearest found one before it in its juan, null at the start."""
    place = F.struct(*[F.col(c).alias(c) for c in ("codepoint", "page", "side", "title")])
    both = wanted.join(found.select("codepoint"), "codepoint", "left_anti").select("codepoint", "juan", order, F.lit(None).cast(found.select(place.alias("p")).schema["p"].dataType).alias("after"))
    both = both.unionByName(found.select("codepoint", "juan", order, place.alias("after")))
    w = Window.partitionBy("juan").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return both.withColumn("before", F.last("after", ignorenulls=True).over(w)).filter("after is null").select("codepoint", "juan", order, F.col("before").alias("after"))


def filtered(items: DataFrame, low: float = 0.8, common_only: bool = True) -> DataFrame:
    """view and codepoint of what each filter shows of glyphs(): todo the unsure ones; open these and what is not approved; all everything; low what is unsure or below `low` and not approved."""
    unsure, done = F.col("status") == "inferred", F.col("status") == "approved"
    views = {"todo": unsure, "open": ~done, "all": F.lit(True), "low": ~done & (unsure | (F.round("similarity", 4) < low))}
    named = F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in views.items()]), lambda x: x.isNotNull())
    return items.filter(F.col("common") if common_only else F.lit(True)).select(F.explode(named).alias("view"), "codepoint", "juan")


def corrections(events: DataFrame, halves: DataFrame) -> DataFrame:
    """Corrections of events(ident, verb, title, page, side, codepoint, new_codepoint, and a box) on half pages that halves(title, page, side, juan) has; comments, unknown verbs and unknown halves give none."""
    action = F.coalesce(*[F.when(F.col("verb") == k, a) for k, (a, _) in ACTIONS.items()])
    target = F.coalesce(*[F.when(F.col("verb") == k, F.col(c)) for k, (_, c) in ACTIONS.items() if c])
    known = halves.select(*HALF, "juan").distinct()
    return events.join(known, HALF).select("ident", *HALF, "juan", action.alias("action"), target.alias("codepoint"), "x", "y", "w", "h").filter("action is not null")


def lines(**parts: DataFrame) -> DataFrame:
    """juan, part and doc, one line of JSON for each row of the parts, which all have juan: a state document that no task has to hold."""
    out = None
    for name, df in parts.items():
        one = df.select("juan", F.lit(name).alias("part"), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("doc"))
        out = one if out is None else out.unionByName(one)
    return out
