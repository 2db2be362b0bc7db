"""Review work: state rows, approvals, corrections from feedback, look-ups with defaults, paging, forced pairs."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella import session
from tessella.operators import fit

TRACED = ("aligned", "manual", "approved")
#: What an event becomes: the corrections, and whether each is for the event's own target or its new one.
CORRECTIONS = {"delete": [("not", "target")], "reject": [("reject", None)], "rebox": [("assign", "target")], "locate": [("assign", "target")], "reassign": [("assign", "new_target")]}


def with_default(df: DataFrame, lookup: DataFrame, key: str, value: str, default) -> DataFrame:
    """df and value from lookup(key, value), the default where there is none (or a null)."""
    return df.join(lookup.select(key, value), key, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def overridden(df: DataFrame, override: DataFrame, key: str, *columns: str) -> DataFrame:
    """df with the columns of override(key, columns) in place of its own where it has the key."""
    o = override.select(F.col(key).alias("k_"), *[F.col(c).alias(f"{c}_") for c in columns], F.lit(True).alias("has_"))
    j = df.join(o, F.col(key) == F.col("k_"), "left")
    return j.select(*[F.when(F.col("has_"), F.col(f"{c}_")).otherwise(F.col(c)).alias(c) if c in columns else c for c in df.columns])


def approve(approved: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """approved and the traced rows(key, status) that it lacks; a key once."""
    new = rows.filter(F.col("status").isin(*TRACED)).select(key).distinct().join(approved, key, "left_anti")
    return approved.select(key).unionByName(new)


def unapprove(approved: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return approved.join(keys.select(key).distinct(), key, "left_anti")


def corrections(events: DataFrame) -> DataFrame:
    """events (verb, target, new_target, ...) as corrections: action and target; a comment or an unknown verb gives none. nth counts an event's."""
    made = F.coalesce(*[F.when(F.col("verb") == verb, F.array(*[F.struct(F.lit(n).alias("nth"), F.lit(a).alias("action"), (F.col(t) if t else F.lit(None).cast(events.schema["target"].dataType)).alias("to")) for n, (a, t) in enumerate(acts)])) for verb, acts in CORRECTIONS.items()])
    keep = [c for c in events.columns if c not in ("verb", "target", "new_target")]
    return events.select(*keep, F.inline(made)).withColumnRenamed("to", "target")


def rewrite_once(c: Column, pattern: str, by: str, strict: bool = True) -> Column:
    """A text with its only match replaced; an error (null if not strict) where there is none or more than one."""
    wrong = F.raise_error(F.concat(F.lit("not just one match in "), c)).cast("string") if strict else F.lit(None).cast("string")
    return F.when(F.regexp_count(c, F.lit(pattern)) == 1, F.regexp_replace(c, pattern, by)).when(c.isNotNull(), wrong)


def forced_cells(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, i, j, gain of the cells that pairs(keys, i, j), applied by rising i, then j, leave in a table of gains: 5 in a pair's own cell, -5 if a later pair has its row or column. (Other cells of their rows and columns are -5.)"""
    order = [F.col("i"), F.col("j")]
    later = lambda by: F.lead(F.lit(1)).over(Window.partitionBy(*keys, by).orderBy(*order)).isNotNull()
    return pairs.select(*keys, "i", "j").distinct().withColumn("gain", F.when(later("i") | later("j"), -5.0).otherwise(5.0))


SMALL = 100_000  # rows that are sorted for a page


def page_of(df: DataFrame, order: list[str], size: int, page: int, small: int = SMALL) -> DataFrame:
    """Page `page` (from 1) of the rows in an order of columns, clamped to the last one and the first.

    The columns are numbers without nulls. The values at the page's first and last row are found by exact selection; only rows between them are sorted, so a deep page costs no sort of what is
    before it. Among the rows of one value the next column decides in the same way.
    """
    n = df.count()
    first = (min(max(page, 1), max(1, -(-n // size))) - 1) * size
    return _stretch(df, order, first, min(size, n - first), n, small)


def _stretch(df: DataFrame, order: list[str], first: int, size: int, n: int, small: int) -> DataFrame:
    """Rows first, ..., first + size - 1 of n rows in an order."""
    if size <= 0:
        return df.limit(0)
    if not order:
        return df.limit(size)  # rows that are level in every column
    if n <= small:
        return df.orderBy(*order).offset(first).limit(size)
    lo, hi = fit.values_at(df, order[0], [first, first + size - 1])
    key = F.col(order[0]).cast("double")
    below, low, high = df.agg(F.count_if(key < lo), F.count_if(key == lo), F.count_if(key == hi)).first()
    if lo == hi:
        return _stretch(df.filter(key == lo), order[1:], first - below, size, low, small)
    head = low - (first - below)  # rows of the least value that the page has
    between = df.filter((key > lo) & (key < hi))  # all on the page
    parts = [(lo, first - below, head, low), (hi, 0, size - head - between.count(), high)]
    ends = [_stretch(df.filter(key == v), order[1:], f, k, m, small) for v, f, k, m in parts]
    return between.unionByName(ends[0]).unionByName(ends[1]).orderBy(*order)


HEAD = 8  # characters of a text by which it meets the names


def resolve_text(wanted: DataFrame, known: DataFrame, text: str, code: str, name: str, most: int = 8) -> DataFrame:
    """text, n, hits (codes, the first `most`): the code itself if it is known and looks like one; else every code whose name holds the text.

    A text meets a name by key: its first HEAD characters are a part of the name of that length, and a longer text is then looked up in the name. Only
    lengths that texts have are cut from the names, nine at most, so a name gives rows in proportion to its own length, and the work does not grow with
    the product of both lists. Inside a scratch block.
    """
    w, k = wanted.select(text).distinct(), known.select(code, name)
    exact = session.cut(w.join(k.select(F.col(code).alias(text)).distinct(), text, "left_semi").filter(F.col(text).rlike("^3[0-9A-F]{4}$")))
    rest = session.cut(w.join(exact, text, "left_anti"))
    heads = rest.filter(F.col(text).isNotNull()).select(F.col(text).alias("text_"), F.substring(text, 1, HEAD).alias("head_"))
    lengths = sorted(r[0] for r in heads.select(F.length("head_")).distinct().collect())  # HEAD + 1 at most
    cuts = lambda n: F.transform(F.sequence(F.lit(1), F.length(name) - n + 1), lambda at: F.substring(F.col(name), at, F.lit(n)))
    parts = [F.when(F.length(name) >= n, cuts(n)) for n in lengths if n]
    parts = [F.coalesce(p, F.array().cast("array<string>")) for p in parts] + [F.array(F.lit("")) if 0 in lengths else F.array().cast("array<string>")]
    dealt = k.filter(F.col(name).isNotNull()).repartition(session.parts(k.sparkSession))  # a small file is one task else
    met = dealt.select(code, name, F.explode(F.array_distinct(F.concat(*parts))).alias("head_")).join(heads, "head_")
    found = session.cut(met.filter(F.contains(F.col(name), F.col("text_"))).select(F.col("text_").alias(text), code))
    # counts are added up in every task, and the first ones of each are ranked there before they meet: a text that all names hold is no large group
    counts = found.groupBy(text).agg(F.count("*").alias("n"))
    first = found.withColumn("r", F.row_number().over(Window.partitionBy(text).orderBy(code))).filter(F.col("r") <= most)
    few = counts.join(first.groupBy(text).agg(F.array_sort(F.collect_list(code)).alias("hits")), text, "left")
    return exact.select(text, F.lit(1).cast("long").alias("n"), F.array(text).alias("hits")).unionByName(rest.join(few, text, "left").select(text, F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("hits", F.array().cast("array<string>")).alias("hits")))


def common_characters() -> list[str]:
    """Characters of the first level of two legacy character sets, by their codecs' lead bytes: A4 to C6, and B0 to D7."""
    def lead(ch, codec):
        b = ch.encode(codec, "ignore")
        return b[0] if len(b) == 2 else 0

    return [ch for ch in map(chr, range(0x3400, 0xA000)) if 0xA4 <= lead(ch, "big5") <= 0xC6 or 0xB0 <= lead(ch, "gb2312") <= 0xD7]


def with_common(df: DataFrame, text: str) -> DataFrame:
    """Adds common: whether any character of a text is a common one; a fixed list of some thousand characters is broadcast."""
    dim = df.sparkSession.createDataFrame([(c,) for c in common_characters()], "ch string")
    rows = df.select(F.col(text).alias("t_")).distinct()
    hit = rows.select("t_", F.explode(F.array_distinct(F.split("t_", ""))).alias("ch")).join(F.broadcast(dim), "ch").select("t_").distinct().withColumn("common", F.lit(True))
    return df.join(hit, F.col(text).eqNullSafe(F.col("t_")), "left").drop("t_").withColumn("common", F.coalesce("common", F.lit(False)))


def cleaned_labels(rows: DataFrame, feature: str, label: str, fold: Column, least: float) -> DataFrame:
    """Rows without the positives whose out-of-fold share of positives, among rows of the same feature in other folds, is below `least`; no such rows count as a share of 0."""
    df = rows.withColumn("fold_", fold)
    per = df.groupBy(feature, "fold_").agg(F.sum(label).alias("p_"), F.count("*").alias("c_"))
    own = Window.partitionBy(feature)
    per = per.select(feature, "fold_", (F.sum("p_").over(own) - F.col("p_")).alias("p_"), (F.sum("c_").over(own) - F.col("c_")).alias("c_"))
    share = F.when(F.col("c_") > 0, F.col("p_") / F.col("c_")).otherwise(0.0)
    named = per.select(F.col(feature).alias("f_"), F.col("fold_").alias("g_"), share.alias("share"))
    j = df.join(F.broadcast(named), F.col(feature).eqNullSafe(F.col("f_")) & (F.col("fold_") == F.col("g_")))  # a row a feature value and fold
    return j.filter((F.col(label) != 1) | (F.col("share") >= least)).select(*rows.columns, "share")
