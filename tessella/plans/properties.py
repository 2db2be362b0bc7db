"""A property table made of the parts, checked by the rules; digests, lengths and completeness."""

from pyspark.sql import functions as F

from tessella.functions import scalars as S
from tessella.operators import rules as R
from tessella.session import prepare, table

FIRST, LAST = 0x3D000, 0x3FC3F
PATTERNS = {"kSource": "^C-[0-9]{5}$", "kOther": "^(TH-[0-9]{5}|TH-X[0-9]{3})$"}


def _lines(spark, sf_dir):
    """All parts as lines of a property table, with every kind of fault at fixed distances."""
    p = table(prepare(spark), sf_dir, "part").select(F.col("p_partkey").alias("k"), "p_size")
    code = F.concat(F.when(F.col("k") % 31 == 0, "u+").otherwise("U+"), S.hex5(F.when(F.col("k") % 97 == 0, F.lit(0x41000)).otherwise(F.lit(0x3D000)) + F.col("k")))
    source = F.when(F.col("k") % 23 == 0, F.concat(F.lit("X-"), F.col("k").cast("string"))).otherwise(F.format_string("C-%05d", F.when(F.col("k") % 41 == 0, 1).otherwise(F.col("k"))))
    modern = F.when(F.col("k") % 29 == 0, "4E0").otherwise(S.hex5(F.lit(0x4E00) + F.col("k")))
    radical = F.concat(F.col("p_size").cast("string"), F.lit("."), S.hex5(F.col("k")), F.when(F.col("k") % 37 == 0, " 7.x").otherwise(""))
    rows = [("kSource", source), ("kModern", modern), ("kRadical", radical)]
    out = F.array(*[F.struct((F.col("k") * 10 + n).alias("line_no"), F.concat_ws("\t", code, F.lit(name), v).alias("line")) for n, (name, v) in enumerate(rows)],
                  F.struct((F.col("k") * 10 + 5).alias("line_no"), F.when(F.col("k") % 17 == 0, F.concat_ws("\t", code, F.lit("kSource"), F.lit("C-99999"))).alias("line")),
                  F.struct((F.col("k") * 10 + 6).alias("line_no"), F.when(F.col("k") % 19 == 0, F.concat_ws("\t", code, F.lit("kNothing"), F.lit("1"))).when(F.col("k") % 43 == 0, code).alias("line")))
    return p.filter("k % 13 <> 0").select(F.inline(out)).filter("line is not null")


def property_violations(spark, sf_dir):
    return R.violations(_lines(spark, sf_dir), FIRST, LAST, PATTERNS, "kModern", "kRadical", ["kSource", "kModern", "kRadical"])


def property_values(spark, sf_dir):
    """The values that hold: of the lines that survive, the last of each code point and property."""
    rows = R.last_values(R.parse(_lines(spark, sf_dir), [*PATTERNS, "kModern", "kRadical"]))
    return rows.filter("last").select("cp", "property", "value")


def property_counts(spark, sf_dir):
    """Code points inside the block by property."""
    return property_values(spark, sf_dir).filter(F.col("cp").between(FIRST, LAST)).groupBy("property").agg(F.countDistinct("cp").alias("n"))


def digest_states(spark, sf_dir):
    """Texts of the benchmark as files, against recorded digests: of the even items, every tenth with another's, and of two that are no files."""
    b = table(prepare(spark), sf_dir, "benchmark").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("data"))
    listed = b.filter("item_id % 2 = 0").select("item_id", F.upper(F.sha2(F.concat("data", F.when(F.col("item_id") % 10 == 0, "!").otherwise("")), 256)).alias("sha256"))
    return R.digests(b, listed.unionByName(spark.createDataFrame([(-1, "00"), (-2, "00")], "item_id long, sha256 string")), "item_id")


def length_changes(spark, sf_dir):
    """Whole texts whose length a conversion changes: one of pairs of letters does, one of single characters does not."""
    b = table(prepare(spark), sf_dir, "benchmark").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("t"))
    changed = lambda c: F.length(c) != F.length("t")
    return b.select("item_id", F.length("t").cast("long").alias("n"), changed(F.replace("t", F.lit("th"), F.lit("T"))).alias("pairs"), changed(F.translate("t", "aeo", "430")).alias("characters"))


def completeness(spark, sf_dir):
    """Covered, wanted and complete by nation: customers with an order are covered."""
    c, o = table(prepare(spark), sf_dir, "customer"), table(spark, sf_dir, "orders")
    have = o.select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("has", F.lit(True))
    n = c.join(have, "c_custkey", "left").groupBy(F.col("c_nationkey").cast("long").alias("nation")).agg(F.count_if("has").alias("covered"), F.count("*").alias("wanted"))
    return n.withColumn("complete", F.col("covered") == F.col("wanted"))


QUERIES = {f.__name__: f for f in (property_violations, property_values, property_counts, digest_states, length_changes, completeness)}

_HEX = "printf('%05X', {})"
_CODE = f"CASE WHEN k % 31 = 0 THEN 'u+' ELSE 'U+' END || {_HEX.format('CASE WHEN k % 97 = 0 THEN 266240 ELSE 249856 END + k')}"
_LINES = f"""p AS (SELECT p_partkey AS k, p_size, {_CODE} AS code FROM part WHERE p_partkey % 13 <> 0),
lines AS (SELECT k * 10 AS line_no, code || chr(9) || 'kSource' || chr(9) || CASE WHEN k % 23 = 0 THEN 'X-' || k ELSE printf('C-%05d', CASE WHEN k % 41 = 0 THEN 1 ELSE k END) END AS line FROM p
UNION ALL SELECT k * 10 + 1, code || chr(9) || 'kModern' || chr(9) || CASE WHEN k % 29 = 0 THEN '4E0' ELSE {_HEX.format('19968 + k')} END FROM p
UNION ALL SELECT k * 10 + 2, code || chr(9) || 'kRadical' || chr(9) || p_size || '.' || {_HEX.format('k')} || CASE WHEN k % 37 = 0 THEN ' 7.x' ELSE '' END FROM p
UNION ALL SELECT k * 10 + 5, code || chr(9) || 'kSource' || chr(9) || 'C-99999' FROM p WHERE k % 17 = 0
UNION ALL SELECT k * 10 + 6, CASE WHEN k % 19 = 0 THEN code || chr(9) || 'kNothing' || chr(9) || '1' ELSE code END FROM p WHERE k % 19 = 0 OR k % 43 = 0),
f AS (SELECT line_no, line, string_split(line, chr(9)) AS x FROM lines),
j AS (SELECT line_no, line, x[1] AS code, x[2] AS property, x[3] AS value, CASE WHEN len(x) <> 3 THEN 'fields' WHEN NOT regexp_full_match(x[1], 'U\\+[0-9A-F]{{4,6}}') THEN 'code_point' WHEN x[2] NOT IN ('kSource', 'kOther', 'kModern', 'kRadical') THEN 'property' END AS skipped FROM f),
g AS (SELECT *, CAST('0x' || substr(code, 3) AS BIGINT) AS cp, row_number() OVER (PARTITION BY code, property ORDER BY line_no) AS nth, count(*) OVER (PARTITION BY code, property) AS o FROM j WHERE skipped IS NULL),
held AS (SELECT * FROM g WHERE nth = o), inb AS (SELECT * FROM held WHERE cp BETWEEN {FIRST} AND {LAST})"""
_REQUIRED = "(VALUES ('kSource'), ('kModern'), ('kRadical')) r(p)"

ORACLE_SQL = {
    "property_violations": f"""WITH {_LINES}
SELECT skipped AS rule, code AS key, line AS detail FROM j WHERE skipped IS NOT NULL
UNION ALL SELECT 'outside', code, property FROM g WHERE cp NOT BETWEEN {FIRST} AND {LAST}
UNION ALL SELECT 'repeated', code, property FROM g WHERE nth > 1
UNION ALL SELECT 'form', code, property || '=' || value FROM g WHERE property = 'kSource' AND NOT regexp_full_match(value, 'C-[0-9]{{5}}') OR property = 'kOther' AND NOT regexp_full_match(value, 'TH-[0-9]{{5}}|TH-X[0-9]{{3}}')
UNION ALL SELECT 'modern', code, value FROM g WHERE property = 'kModern' AND NOT regexp_full_match(value, '[0-9A-F]{{4,5}}')
UNION ALL SELECT 'radical', code, r FROM (SELECT code, unnest(string_split(value, ' ')) AS r FROM g WHERE property = 'kRadical') WHERE NOT regexp_full_match(r, '[0-9]{{1,3}}\\.[0-9A-F]{{5}}')
UNION ALL SELECT 'shared', min(code), property || '=' || value FROM held WHERE property IN ('kSource', 'kOther') GROUP BY property, value HAVING count(*) > 1
UNION ALL SELECT 'required', 'U+' || {_HEX.format('cp')}, p FROM (SELECT DISTINCT cp FROM inb), {_REQUIRED} WHERE NOT EXISTS (FROM inb i WHERE i.cp = "unnamed_subquery".cp AND i.property = p)
UNION ALL SELECT 'absent', 'U+' || {_HEX.format('cp')}, '' FROM range({FIRST}, {LAST + 1}) t(cp) WHERE cp NOT IN (SELECT cp FROM inb)
UNION ALL SELECT 'total', '', n::VARCHAR FROM (SELECT count(DISTINCT cp) AS n FROM inb) WHERE n <> {LAST - FIRST + 1}""".replace('(SELECT DISTINCT cp FROM inb), (VALUES', '(SELECT DISTINCT cp FROM inb) u, (VALUES').replace('"unnamed_subquery".cp', 'u.cp'),
    "property_values": f"WITH {_LINES} SELECT cp, property, value FROM held",
    "property_counts": f"WITH {_LINES} SELECT property, count(DISTINCT cp) AS n FROM inb GROUP BY property",
    "digest_states": """SELECT item_id::BIGINT AS item_id, CASE WHEN item_id % 2 <> 0 THEN 'unrecorded' WHEN item_id % 10 = 0 THEN 'differs' ELSE 'same' END AS state FROM benchmark UNION ALL VALUES (-1, 'unread'), (-2, 'unread')""",
    "length_changes": "SELECT item_id::BIGINT AS item_id, length(text) AS n, length(replace(text, 'th', 'T')) <> length(text) AS pairs, false AS characters FROM benchmark",
    "completeness": "SELECT c_nationkey::BIGINT AS nation, count_if(EXISTS (FROM orders WHERE o_custkey = c_custkey))::BIGINT AS covered, count(*) AS wanted, count_if(EXISTS (FROM orders WHERE o_custkey = c_custkey)) = count(*) AS complete FROM customer GROUP BY c_nationkey",
}
