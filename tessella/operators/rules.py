"""Rules of a property table as one frame of violations (rule, key, detail), and checks of digests, lengths and completeness.

A rule sees only the rows that survive the rules before it: lines of other than three fields, with a malformed code
point or an unknown property are reported once and go no further; code points outside the block and repeated properties
are reported and stay, the last line's value holding.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions import scalars as S


def _found(df: DataFrame, key: Column, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
    """rule, key, detail for every rule (broken, detail) that a row breaks: one pass, whatever the number of rules. A null test is no break."""
    hits = F.filter(F.array(*[F.when(bad, F.struct(F.lit(k).alias("rule"), key.alias("key"), detail.alias("detail"))) for k, (bad, detail) in rules.items()]), lambda x: x.isNotNull())
    return df.select(F.inline(hits))


def parse(lines: DataFrame, known: list[str]) -> DataFrame:
    """line_no, line, skipped (the rule that ends a line's way, null for none), cp, property, value of lines(line_no, line). Null lines have no fields."""
    f = F.split(F.coalesce("line", F.lit("")), "\t")
    df = lines.select("line_no", "line", F.size(f).alias("n"), *[F.get(f, k).alias(c) for k, c in enumerate(("code", "property", "value"))])
    skipped = F.when(F.col("n") != 3, "fields").when(~F.col("code").rlike(r"^U\+[0-9A-F]{4,6}$"), "code_point").when(~F.col("property").isin(known), "property")
    return df.select("line_no", "line", skipped.alias("skipped"), F.when(skipped.isNull(), F.conv(F.substring("code", 3, 6), 16, 10).cast("long")).alias("cp"), "code", "property", "value")


def last_values(parsed: DataFrame) -> DataFrame:
    """The surviving lines, the last one of each code point and property, and first (no line before it had both)."""
    own = Window.partitionBy("cp", "property")
    kept = parsed.filter("skipped is null").withColumn("nth", F.row_number().over(own.orderBy("line_no"))).withColumn("of", F.count("*").over(own))
    return kept.withColumn("last", F.col("nth") == F.col("of"))


def violations(lines: DataFrame, first: int, last: int, patterns: dict[str, str], modern: str, radical: str, required: list[str]) -> DataFrame:
    """Rows (rule, key, detail) of lines(line_no, line), a table of tab-separated code points, properties and values.

    patterns: a value's form by source property; modern, radical: the properties with one code point, with radicals.
    """
    parsed = parse(lines, [*patterns, modern, radical])
    rows = last_values(parsed)
    form = F.coalesce(*[F.when(F.col("property") == k, ~F.col("value").rlike(p)) for k, p in patterns.items()])
    each = _found(rows, F.col("code"), {
        "outside": (~F.col("cp").between(first, last), F.col("property")),
        "repeated": (F.col("nth") > 1, F.col("property")),
        "form": (form, F.concat_ws("=", "property", "value")),
        "modern": ((F.col("property") == modern) & ~F.col("value").rlike("^[0-9A-F]{4,5}$"), F.col("value")),
    })
    skipped = parsed.filter("skipped is not null").select(F.col("skipped").alias("rule"), F.coalesce("code", F.lit("")).alias("key"), F.coalesce("line", F.lit("")).alias("detail"))
    parts = rows.filter(F.col("property") == radical).select("code", F.explode(F.split("value", " ")).alias("r")).filter(~F.col("r").rlike(r"^\d{1,3}\.[0-9A-F]{5}$"))
    radicals = parts.select(F.lit("radical").alias("rule"), F.col("code").alias("key"), F.col("r").alias("detail"))
    held = rows.filter("last")
    sources = held.filter(F.col("property").isin(list(patterns))).groupBy("property", "value").agg(F.count("*").alias("n"), F.min("code").alias("code")).filter("n > 1")
    shared = sources.select(F.lit("shared").alias("rule"), F.col("code").alias("key"), F.concat_ws("=", "property", "value").alias("detail"))
    inside = held.filter(F.col("cp").between(first, last))
    per = inside.groupBy("cp").agg(F.collect_set("property").alias("have"))  # as many as there are known properties
    lacks = per.select("cp", F.explode(F.array_except(F.array(*map(F.lit, required)), "have")).alias("p")).select(F.lit("required").alias("rule"), F.concat(F.lit("U+"), S.hex5("cp")).alias("key"), F.col("p").alias("detail"))
    absent = lines.sparkSession.range(first, last + 1).select(F.col("id").alias("cp")).join(per, "cp", "left_anti").select(F.lit("absent").alias("rule"), F.concat(F.lit("U+"), S.hex5("cp")).alias("key"), F.lit("").alias("detail"))
    total = per.agg(F.count("*").alias("n")).filter(F.col("n") != last - first + 1).select(F.lit("total").alias("rule"), F.lit("").alias("key"), F.col("n").cast("string").alias("detail"))
    return reduce(DataFrame.unionByName, [skipped, each, radicals, shared, lacks, absent, total])


def digests(files: DataFrame, recorded: DataFrame, key: str) -> DataFrame:
    """key, state of recorded digests against files(key, data): same, differs, unread (no such file), unrecorded."""
    have = files.select(key, F.sha2("data", 256).alias("have"))
    j = recorded.select(key, F.lower("sha256").alias("want"), F.lit(True).alias("listed")).join(have, key, "full")
    return j.select(key, F.when(F.col("listed").isNull(), "unrecorded").when(F.col("have").isNull(), "unread").when(F.col("want") == F.col("have"), "same").otherwise("differs").alias("state"))
