"""Vector similarity over embeddings. Queries are the rows whose id is divisible by 50. The *_all queries compare them with every other row, the others with rows of their own label only, as detections meet what is expected in their block."""

from pyspark.sql import functions as F

from tessella.functions import scalars as S
from tessella.operators import vectors as V
from tessella.session import prepare, table


def _vectors(spark, sf_dir):
    df = table(prepare(spark), sf_dir, "embeddings")
    return df.select("vec_id", "label", S.unit(F.col("embedding").cast("array<double>")).alias("v"))


def unit_vectors(spark, sf_dir):
    return _vectors(spark, sf_dir).select("vec_id", F.posexplode("v").alias("dim", "x")).select("vec_id", F.col("dim").cast("long").alias("dim"), S.r6(F.col("x")).alias("x"))


def _pairs(spark, sf_dir, every=False):
    df = table(prepare(spark), sf_dir, "embeddings")
    return V.blocks(df.filter("vec_id % 50 = 0"), df, "vec_id", "embedding", None if every else "label")


def similarity_pairs(spark, sf_dir):
    return V.similarities(_pairs(spark, sf_dir))


def similarity_top1(spark, sf_dir):
    """The nearest of the label's other rows. Vectors without a direction are nobody's nearest."""
    return V.nearest(_pairs(spark, sf_dir))


def shift_max(spark, sf_dir):
    return V.similarities(_pairs(spark, sf_dir), V.shifted)


def similarity_pairs_all(spark, sf_dir):
    return V.similarities(_pairs(spark, sf_dir, True))


def similarity_top1_all(spark, sf_dir):
    """The nearest of all other rows. Vectors without a direction are nobody's nearest."""
    return V.nearest(_pairs(spark, sf_dir, True))


def shift_max_all(spark, sf_dir):
    return V.similarities(_pairs(spark, sf_dir, True), V.shifted)


QUERIES = {f.__name__: f for f in (unit_vectors, similarity_pairs, similarity_top1, shift_max, similarity_pairs_all, similarity_top1_all, shift_max_all)}

_UNIT = """WITH d AS (SELECT vec_id, label, embedding::DOUBLE[] AS r FROM embeddings), c AS (SELECT vec_id, label, list_transform(r, lambda x: x - list_sum(r) / len(r)) AS c FROM d),
u AS (SELECT vec_id, label, list_transform(c, lambda x: x / sqrt(list_inner_product(c, c))) AS v FROM c)"""
_QUERY = "FROM u q JOIN u w ON q.label = w.label AND q.vec_id <> w.vec_id WHERE q.vec_id % 50 = 0"

ORACLE_SQL = {
    "unit_vectors": f"{_UNIT} SELECT vec_id, (unnest(range(1, len(v) + 1)) - 1)::BIGINT AS dim, round(unnest(v), 6) AS x FROM u",
    "similarity_pairs": f"{_UNIT} SELECT q.vec_id AS query_id, w.vec_id, round(list_inner_product(q.v, w.v), 6) AS similarity {_QUERY}",
    "similarity_top1": f"{_UNIT}, s AS (SELECT q.vec_id AS query_id, w.vec_id, round(list_inner_product(q.v, w.v), 6) AS similarity {_QUERY}), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS n FROM s) SELECT query_id, vec_id, similarity FROM r WHERE n = 1",
    "shift_max": f"""{_UNIT}, p AS (SELECT q.vec_id AS query_id, w.vec_id, q.v AS qv, w.v {_QUERY}),
s AS (SELECT query_id, vec_id, qv, list_transform(range(1, len(v) + 1), lambda i: CASE WHEN i - k BETWEEN 1 AND len(v) THEN v[i - k] ELSE 0 END) AS t FROM p, (SELECT unnest(range(-2, 3)) AS k)),
m AS (SELECT query_id, vec_id, qv, list_transform(t, lambda x: x - list_sum(t) / len(t)) AS c FROM s)
SELECT query_id, vec_id, round(max(list_inner_product(c, qv) / sqrt(list_inner_product(c, c))), 6) AS similarity FROM m GROUP BY query_id, vec_id""",
}
# the same over all rows: the SQL above without its condition on the label
ORACLE_SQL |= {f"{k}_all": ORACLE_SQL[k].replace("q.label = w.label AND ", "") for k in ("similarity_pairs", "similarity_top1", "shift_max")}
