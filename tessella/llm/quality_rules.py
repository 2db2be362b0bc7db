"""Quality rules whose thresholds come from the corpus, with DataFrame functions only.

Four rates of a document (symbols, capitals, repeated lines, words equal to the one before) and its mean word length
are compared with fences around the quartiles of its language and source. Quantiles come from mergeable
KLL sketches: one a (language, source), merged into one a language and one of all; a group of fewer than
`least` documents takes its language's fences, a language of fewer those of all. The fences then meet the
documents in a join, and what lies outside goes: the fences are broadcast if their groups are counted to be few, else
dealt with the documents by group and salt, so that a large group has no task of its own.

A fence is `reach` quartile distances beyond the quartile. Where almost all documents of a group have the same rate, as in groups of copies or of
texts without any symbol, that distance says nothing; then the least distance is what a few more symbols, capitals or words make in the group's
typical text, so that it too comes from a quantile of the group: from the median of its words, signs or lines, or of its word length. No fence is a constant.

Defined results: a null text has no words; null languages and sources are groups of their own; repeated
rows count each; an empty table gives no rows; documents below the base rules are not kept and do not
shape the fences.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella import session

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: rate: (how many of its events in a typical text are the least distance between quartiles, the size of a text that they are divided by, fence below as well); a word length by a part of the typical one
RATES = {"symbol_rate": (3.0, "n_words", False), "capital_rate": (4.0, "word_chars", False), "line_rate": (0.5, "n_lines", False), "same_rate": (2.0, "n_words", False), "word_length": (0.05, None, True)}
SIZES = ("n_words", "word_chars", "n_lines")
SKETCH_K = 1024
REACH, LEAST = 6.0, 200
GROUPS = 20_000  # groups whose fences are broadcast (some 200 bytes each)
SALTS = 32


def counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns of keep and n_words, word_chars, n_symbols, n_capitals, n_lines, n_dup_lines, n_repeat_words, n_same_words of docs(text)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(*keep, text.alias("text_"))
    lines = F.filter(F.split("text_", "\n"), lambda x: x.rlike(WORD))
    df = df.select(
        *keep,
        F.regexp_extract_all("text_", F.lit(WORD), F.lit(0)).alias("words_"),
        F.length(F.translate("text_", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("text_") - F.length(F.translate("text_", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length("text_") - F.length(F.regexp_replace("text_", r"\p{Lu}+", ""))).cast("long").alias("n_capitals"),
        lines.alias("lines_"),
    )
    df = df.select("*", F.size("words_").cast("long").alias("n_words"), F.transform("words_", lambda w: F.xxhash64(w)).alias("hash_"), F.size("lines_").cast("long").alias("n_lines"), (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long").alias("n_dup_lines"))
    h = F.col("hash_")
    windows = F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[h[i + k] for k in range(WINDOW)]))
    df = df.withColumn("n_same_words", F.size(F.filter(h, lambda x, i: x == F.get(h, i - 1))).cast("long"))
    df = df.withColumn("windows_", F.when(F.size(h) >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")))
    # only documents with a repeated window need its places
    df = df.withColumn("places_", F.when(F.size(F.array_distinct("windows_")) < F.size("windows_"), F.sort_array(F.transform("windows_", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    s = F.col("places_")
    again = F.transform(s, lambda e, j: F.when((F.get(s, j - 1)["x"] == e["x"]) | (F.get(s, j + 1)["x"] == e["x"]), e["i"]))
    df = df.withColumn("at_", F.sort_array(F.filter(again, lambda x: x.isNotNull())))
    at = F.col("at_")
    covered = F.aggregate(F.transform(at, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - p, F.lit(WINDOW))).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
    return df.select(*keep, "n_words", "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines", "n_repeat_words", "n_same_words")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rates() -> dict[str, Column]:
    words, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "symbol_rate": F.col("n_symbols") / words,
        "capital_rate": F.col("n_capitals") / F.greatest(F.col("word_chars"), F.lit(1)),
        "line_rate": F.col("n_dup_lines") / lines,
        "same_rate": F.col("n_same_words") / words,
        "word_length": F.col("word_chars") / words,
    }


def fences(measured: DataFrame, reach: float = REACH, least: int = LEAST) -> DataFrame:
    """lang, source and {rate}_low, {rate}_high for every group of measured(lang, source, n_words, ...)."""
    drawn = (*RATES, *SIZES)
    fit = measured.filter(~base_failed()).select("lang", "source", *[c.alias(k) for k, c in rates().items()], *[F.col(c).cast("double").alias(c) for c in SIZES])
    by_group = session.cut(fit.groupBy("lang", "source").agg(F.count("*").alias("n"), *[F.kll_sketch_agg_double(k, SKETCH_K).alias(k) for k in drawn]))
    merged = lambda df: df.agg(F.sum("n").alias("n"), *[F.kll_merge_agg_double(k, SKETCH_K).alias(k) for k in drawn])
    by_lang = merged(by_group.groupBy("lang"))
    whole = merged(by_group.groupBy())
    named = lambda df, p: df.select(*[F.col(c).alias(c if c in ("lang", "source") else f"{p}{c}") for c in df.columns])
    all_groups = measured.select("lang", "source").distinct()
    groups = all_groups.alias("m").join(named(by_group, "g_").alias("g"), F.col("m.lang").eqNullSafe(F.col("g.lang")) & F.col("m.source").eqNullSafe(F.col("g.source")), "left")
    groups = groups.select("m.lang", "m.source", *[f"g_{c}" for c in ("n", *drawn)])
    groups = groups.alias("m").join(named(by_lang, "l_").alias("l"), F.col("m.lang").eqNullSafe(F.col("l.lang")), "left").select("m.*", *[f"l_{c}" for c in ("n", *drawn)])
    groups = groups.join(F.broadcast(named(whole, "a_")))  # one row
    out = []

    def quantile(k, q):
        sketch = F.when(F.col("g_n") >= least, F.col(f"g_{k}")).when(F.col("l_n") >= least, F.col(f"l_{k}")).otherwise(F.col(f"a_{k}"))
        return F.kll_sketch_get_quantile_double(sketch, F.lit(q))

    for k, (events, size, below) in RATES.items():
        low, high = quantile(k, 0.25), quantile(k, 0.75)
        typical = events / F.greatest(quantile(size, 0.5), F.lit(1.0)) if size else events * quantile(k, 0.5)
        width = F.greatest(high - low, typical)
        out += [(low - reach * width).alias(f"{k}_low") if below else F.lit(-1.0).alias(f"{k}_low"), (high + reach * width).alias(f"{k}_high")]
    return groups.filter("a_n > 0").select("lang", "source", *out)


def _with_fences(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """measured and the fences of a row's group, null where there are none."""
    same = F.col("d.lang").eqNullSafe(F.col("f.lang")) & F.col("d.source").eqNullSafe(F.col("f.source"))
    limits = session.cut(limits)
    if limits.count() <= GROUPS:
        return measured.alias("d").join(F.broadcast(limits).alias("f"), same, "left")
    left = measured.withColumn("salt_", F.pmod(F.xxhash64("n_words", "word_chars", "n_symbols"), F.lit(SALTS)).cast("int"))
    right = limits.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.alias("d").join(right.alias("f"), same & (F.col("d.salt_") == F.col("f.salt_")), "left")


def _measured(docs: DataFrame, row: list[Column]) -> DataFrame:
    """The columns of row in a struct, lang, source and the counts of every row of docs(text, lang, source)."""
    return counts(docs.select(F.struct(*row).alias("row"), "text", "lang", "source"), ["row", "lang", "source"])


def _verdict(measured: DataFrame, shaped: DataFrame, reach: float, least: int) -> DataFrame:
    """measured, base_failed and kept, by the fences of shaped."""
    joined = _with_fences(measured, fences(shaped, reach, least))
    inside = F.lit(True)
    for k, c in rates().items():
        inside &= F.coalesce(c.between(F.col(f"{k}_low"), F.col(f"{k}_high")), F.lit(True))
    return joined.select(*[F.col(f"d.{c}") for c in measured.columns], base_failed().alias("base_failed"), (~base_failed() & inside).alias("kept"))


def judge(docs: DataFrame, key: str = "doc_id", reach: float = REACH, least: int = LEAST) -> DataFrame:
    """key, lang, source, the counts, base_failed and kept of every row of docs(key, text, lang, source)."""
    measured = session.cut(_measured(docs, [F.col(key)]))
    out = _verdict(measured, measured, reach, least)
    return out.select(f"row.{key}", *[c for c in out.columns if c != "row"])


def keep(docs: DataFrame, reach: float = REACH, least: int = LEAST) -> DataFrame:
    """The rows of docs that the rules keep, whole; repeated rows each get their verdict.

    No text is written before its verdict: the counts that shape the fences are written without the rows, and taken once more where the rows meet
    the fences. That costs a second scan; rows with their counts would take the texts' size of disk, until the job ends.
    """
    shaped = session.cut(_measured(docs, [F.lit(0).alias("none")]).drop("row"))
    out = _verdict(_measured(docs, [F.col(f"`{c}`") for c in docs.columns]), shaped, reach, least)
    # one condition over both sides of the join: as a conjunction its parts would go below the counts and take them again for each use
    return out.filter(F.forall(F.array("kept"), lambda x: x)).select("row.*")
