"""Merkle fingerprints of documents, with DataFrame functions only.

The tree of a text: paragraphs are lines; a leaf is a run of words, with the white space behind them, that ends at a word
whose MD5 begins with 0 to 3 (every fourth word, on average) or with the line; a section is a run of paragraphs that ends at
one whose hash begins with 0 (every sixteenth); the root is over the sections. All borders come from the text itself, so
what is put in or taken out moves none but its own. Every node is the SHA-256 of its level's letter and its children, so
equal roots mean equal texts, and two trees differ just on the paths to what was edited. A fingerprint is the root, a
slash, and the first eight hex digits of each leaf; a dot ends a paragraph, a semicolon parts sections.

Two fingerprints are compared from the top: equal roots are alike; sections that both have are passed over whole, then
paragraphs that both have below the others, and only below what is left are leaves compared.

Defined results: a null text is an empty one; two empty texts are alike (1.0), an empty one and another are not (0.0);
documents with the same id are ordered by text; null ids come first; the next of the only document is itself; other
columns are ignored. An id that many rows share keeps them in one range of ids: ids are meant to be told apart.
"""

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|[\x20\x09-\x0D]+"


def _marked(items: Column, is_end, mark: str) -> Column:
    """An array's strings in a row, with a mark after those that end a run."""
    return F.array_join(F.transform(items, lambda x: F.concat(x, F.when(is_end(x), mark).otherwise(""))), "")


def _pieces(joined: Column, mark: str) -> Column:
    return F.filter(F.split(joined, mark), lambda x: x != "")


def with_tree(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """Add {prefix}root and {prefix}parts, a section's leaves an entry as in the fingerprint, of a text column.

    Runs are split at marks, which lines and hashes do not have, so that the work is in proportion to the text.
    """
    leaves, hashes, shorts = (f"{prefix}{x}_" for x in ("leaves", "hashes", "shorts"))
    kept = df.columns
    words = lambda p: F.regexp_extract_all(p, F.lit(WORD), F.lit(0))
    runs = lambda p: _pieces(_marked(words(p), lambda w: F.substring(F.md5(w), 1, 1) < "4", "\n"), "\n")
    df = df.withColumn(leaves, F.transform(F.split(F.col(text), "\n"), lambda p: F.transform(runs(p), lambda x: F.sha2(F.concat(F.lit("l"), x), 256))))
    df = df.withColumn(hashes, F.transform(leaves, lambda x: F.sha2(F.concat(F.lit("p"), F.array_join(x, "")), 256)))
    last = lambda h: F.substring(h, 1, 1) == "0"
    df = df.withColumn(shorts, F.zip_with(leaves, hashes, lambda x, h: F.concat(F.array_join(F.transform(x, lambda y: F.substring(y, 1, 8)), ""), F.when(last(h), ".;").otherwise("."))))
    sections = F.transform(_pieces(_marked(F.col(hashes), last, ";"), ";"), lambda x: F.sha2(F.concat(F.lit("s"), x), 256))
    return df.select(*kept, F.sha2(F.concat(F.lit("r"), F.array_join(sections, "")), 256).alias(f"{prefix}root"), _pieces(F.array_join(shorts, ""), ";").alias(f"{prefix}parts"))


def fingerprint(prefix: str) -> Column:
    return F.concat(F.col(f"{prefix}root"), F.lit("/"), F.array_join(f"{prefix}parts", ";"))


def _weight(parts: Column) -> Column:
    """The leaves of distinct sections or paragraphs."""
    return F.floor(F.length(F.translate(F.array_join(parts, ""), ".", "")) / 8)


def with_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Add the likeness of two trees, by prefix: twice the leaves that they share over the leaves they have; and {name}_open, the paragraphs of a that b lacks.

    A section, paragraph or leaf that occurs again in a tree counts once.
    """
    pa, pb = F.col(f"{a}parts"), F.col(f"{b}parts")
    paragraphs = lambda x: F.split(F.array_join(x, ""), r"\.")
    leaves = lambda x: F.array_distinct(F.regexp_extract_all(F.array_join(x, ""), F.lit("[^.]{8}"), F.lit(0)))
    kept = df.columns
    df = df.select("*", F.array_intersect(pa, pb).alias("s_"), paragraphs(F.array_except(pa, pb)).alias("x_"), paragraphs(F.array_except(pb, pa)).alias("y_"))
    df = df.select("*", F.array_intersect("x_", "y_").alias("p_"), F.array_except("x_", "y_").alias("open_"), F.array_except("y_", "x_").alias("z_"))
    df = df.select("*", leaves(F.col("open_")).alias("k_"), leaves(F.col("z_")).alias("l_"), (_weight(F.col("s_")) + _weight(F.col("p_"))).alias("w_"))
    shared, both = F.col("w_") + F.size(F.array_intersect("k_", "l_")), 2 * F.col("w_") + F.size("k_") + F.size("l_")
    same = F.col(f"{a}root") == F.col(f"{b}root")
    return df.select(*kept, F.when(same, 1.0).when(both == 0, 0.0).otherwise(2.0 * shared / both).alias(name), F.size(F.filter("open_", lambda x: x != "")).cast("long").alias(f"{name}_open"))


def edits(pairs: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """key, paragraph (its number, from 0), changed of texts a: the paragraphs below sections that b's tree lacks, and whether b lacks the paragraph as well.

    pairs(key, a, b) holds two texts a row; key tells the rows apart. Paragraphs meet as rows, so a long text is no single task's.
    """
    trees = with_tree(with_tree(pairs.select(F.col(key).alias("key"), F.coalesce(a, F.lit("")).alias("a"), F.coalesce(b, F.lit("")).alias("b")), "a", "a_"), "b", "b_").filter("a_root != b_root")
    sections = lambda p: trees.select("key", F.posexplode(f"{p}parts").alias("nth", "part"), F.regexp_count("part", F.lit(r"\.")).alias("n"))
    ours = sections("a_").withColumn("base", F.sum("n").over(Window.partitionBy("key").orderBy("nth")) - F.col("n"))
    theirs = sections("b_")
    open_ = ours.join(theirs.select("key", "part").distinct(), ["key", "part"], "left_anti")
    inside = open_.select("key", "base", F.posexplode(F.split(F.regexp_replace("part", r"\.$", ""), r"\.")).alias("at", "leaves"))
    have = theirs.select("key", F.explode(F.split(F.regexp_replace("part", r"\.$", ""), r"\.")).alias("leaves"), F.lit(True).alias("there")).distinct()
    return inside.join(have, ["key", "leaves"], "left").select(F.col("key").alias(key), (F.col("base") + F.col("at")).alias("paragraph"), F.col("there").isNull().alias("changed"))


def with_next(docs: DataFrame, rows_a_bucket: int = 500, most_buckets: int = 100_000) -> DataFrame:
    """doc_id, text, next_text of docs(doc_id, text): the next row's text in the order of (doc_id, text), around the end.

    Rows are dealt to ranges of ids between quantiles; a range ends with a copy of the next range's first
    row, so that no global order is needed and whole texts move once. Only the numbers of the ranges are ordered as one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = min(most_buckets, max(1, math.ceil(docs.count() / rows_a_bucket)))
    cuts = sorted(set(docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 1 / (4 * n)))) if n > 1 else []
    cuts = [-math.inf, *(cuts or [0.0]), math.inf]
    bucketizer = Bucketizer(splits=cuts, inputCol="id_", outputCol="bucket_", handleInvalid="keep")
    rows = bucketizer.transform(docs.withColumn("id_", F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0))))
    rows = rows.select("doc_id", "text", F.when(F.col("doc_id").isNull(), -1).otherwise(F.col("bucket_").cast("int")).alias("bucket"))
    # a row a bucket, so bounded by most_buckets; bucket -1 (no id) finds its first text by the null-safe join
    lowest = rows.groupBy("bucket").agg(F.min("doc_id").alias("doc_id"))
    before = F.coalesce(F.lag("bucket").over(Window.orderBy("bucket")), F.max("bucket").over(Window.partitionBy()))
    lowest = F.broadcast(lowest.select(F.col("bucket").alias("b_"), F.col("doc_id").alias("d_"), before.alias("before_")))
    heads = rows.join(lowest, (F.col("bucket") == F.col("b_")) & F.col("doc_id").eqNullSafe(F.col("d_")))
    ends = heads.groupBy(F.col("before_").alias("bucket")).agg(F.min(F.struct("doc_id", "text")).alias("row")).select("row.doc_id", "row.text", "bucket")
    dealt = rows.withColumn("copy", F.lit(False)).unionByName(ends.withColumn("copy", F.lit(True)))
    within = Window.partitionBy("bucket").orderBy("copy", F.asc_nulls_first("doc_id"), "text")
    return dealt.withColumn("next_text", F.lead("text").over(within)).filter(~F.col("copy")).select("doc_id", "text", "next_text")


def compare(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of docs(doc_id, text), of its edited text and their likenesses (see the contract of op5), and the paragraphs that only the text has, against the edited one."""
    df = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    df = df.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half), F.substring(F.col("next_text"), F.lit(1), half)))
    df = df.withColumn("edited_sha256", F.sha2("edited", 256))
    for column, prefix in (("text", "a_"), ("edited", "b_"), ("next_text", "c_")):
        df = with_tree(df, column, prefix).drop(column if column != "text" else "")
    df = with_likeness(with_likeness(df, "a_", "b_", "near_edited"), "a_", "c_", "near_next")
    return df.select("doc_id", "n_chars", "edited_sha256", fingerprint("a_").alias("fingerprint"), fingerprint("b_").alias("edited_fingerprint"), "near_edited", "near_next", F.col("near_edited_open").alias("n_edited_paragraphs"))
