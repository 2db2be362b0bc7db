"""Similarities of queries and rows: Spark deals both sides in blocks of counted size, every block of queries meets every block of rows once, and a pair of blocks is a product of matrices.

Vectors are dealt as they are; a task moves them to mean 0 and scales them to length 1. Those without a direction have none. A pair in which one has none, or whose lengths differ, has no similarity.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella import session

QUERIES, ROWS = 8192, 4096  # vectors of a block, about
SLICE = 1 << 20  # pairs of a product
PAIRS = 1 << 24  # pairs that are ordered at a time
SHIFTS = range(-2, 3)
PART = 1 << 16  # rows of a batch that goes back to Spark
SCALE = 1e6  # similarities have six digits and are whole numbers below
NONE, NAN = 1 << 34, (1 << 34) + 1  # no similarity; not a number

Product = Callable[[np.ndarray, np.ndarray], np.ndarray]


def blocks(queries: DataFrame, rows: DataFrame, ident: str, vector: str, group: str | None):
    """Both sides dealt for similarities() and nearest(): queries meet the rows of their group (null: nobody), or all rows.

    A row is sent once to every block of its group's queries, a query once to every block of its group's rows: no task holds more than a block of each,
    and what is sent grows with the number of pairs over the size of a block. The blocks are dealt to the partitions in turn, and these are not joined by their size, which is small beside what is made of them.
    """
    g = F.col(group) if group else F.lit(0)
    q, w = (df.select(g.alias("g_"), F.col(ident).alias("id_"), F.col(vector).alias("v_")).filter("g_ is not null and id_ is not null") for df in (queries, rows))
    many = lambda df, size, name: df.groupBy("g_").agg(F.ceil(F.count("*") / size).cast("int").alias(name))
    sizes = many(q, QUERIES, "qs_").join(many(w, ROWS, "ws_"), "g_")
    dealt = lambda n: F.pmod(F.xxhash64("id_", "v_"), F.col(n)).cast("int")
    copies = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    spark = queries.sparkSession
    n = max(session.parts(spark), 4 * spark.sparkContext.defaultParallelism)
    turn = F.pmod(F.pmod(F.xxhash64("g_"), F.lit(n)) + F.col("qb_").cast("long") * F.col("ws_") + F.col("wb_"), F.lit(n)).cast("int").alias("to_")
    q = q.join(sizes, "g_").select("g_", "ws_", dealt("qs_").alias("qb_"), copies("ws_").alias("wb_"), F.lit(True).alias("query_"), "id_", "v_")
    w = w.join(sizes, "g_").select("g_", "ws_", copies("qs_").alias("qb_"), dealt("ws_").alias("wb_"), F.lit(False).alias("query_"), "id_", "v_")
    both = q.unionByName(w).select(turn, "g_", "qb_", "wb_", "query_", "id_", "v_")
    return both.repartitionById(n, F.col("to_")).groupBy("to_", "g_", "qb_", "wb_")


def plain(q: np.ndarray, w: np.ndarray) -> np.ndarray:
    return q @ w.T


def shifted(q: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The largest similarity of a query and a row that is moved by up to two places, and made a unit vector again; 0 for a move that leaves no direction."""
    best, n = None, w.shape[1]
    for k in SHIFTS:
        moved = np.zeros_like(w)
        if abs(k) < n:
            moved[:, max(k, 0) : n + min(k, 0)] = w[:, max(-k, 0) : n + min(-k, 0)]
        moved -= moved.mean(axis=1, keepdims=True)
        square = (moved * moved).sum(axis=1, keepdims=True)
        unit = np.divide(moved, np.sqrt(square), out=np.zeros_like(moved), where=square != 0)
        best = q @ unit.T if best is None else np.maximum(best, q @ unit.T)
    return best


def _vectors(column: pa.ChunkedArray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Length, places and unit vectors of a column, for each length that it has; nulls, and those with a null or without a direction, are left out.

    Sums are taken one by one, as scalars.unit() takes them: whether a length is 0 hangs on it.
    """
    lists = column.combine_chunks()
    size = np.asarray(lists.value_lengths().fill_null(-1))
    flat, ends = lists.flatten(), np.cumsum(np.maximum(size, 0))
    known = np.asarray(flat.is_valid().to_numpy(zero_copy_only=False), bool)
    flat = np.asarray(flat.to_numpy(zero_copy_only=False), float)
    out = []
    for n in sorted(set(size.tolist()) - {-1, 0}):
        at = np.flatnonzero(size == n)
        places = (ends[at] - n)[:, None] + np.arange(n)
        at, places = at[known[places].all(axis=1)], places[known[places].all(axis=1)]
        x = flat[places]
        x = x - np.cumsum(x, axis=1)[:, -1:] / n
        square = np.cumsum(x * x, axis=1)[:, -1]
        on = ~(square <= 0)
        out.append((n, at[on], x[on] / np.sqrt(square[on])[:, None]))
    return out


def _whole(x: np.ndarray) -> np.ndarray:
    """Millionths, halves away from 0."""
    x = np.trunc(x * SCALE + np.copysign(0.5, x))
    return np.where(np.isnan(x), NAN, x).astype(np.int64)


def _slices(batches: Iterator[pa.RecordBatch], product: Product, none: int, by_id: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """A block's ids of queries and of rows and the millionths of all their pairs, some queries at a time; `none` stands for a missing similarity."""
    table = pa.Table.from_batches(list(batches))
    left, right = (table.filter(x) for x in (table["query_"], pc.invert(table["query_"])))
    if not left.num_rows or not right.num_rows:
        return
    if by_id:
        right = right.sort_by("id_")
    q, w = left["id_"].to_numpy(), right["id_"].to_numpy()
    queries, rows = _vectors(left["v_"]), {n: (at, m) for n, at, m in _vectors(right["v_"])}
    step = max(1, SLICE // len(w))
    for first in range(0, len(q), step):
        ids = q[first : first + step]
        value = np.full((len(ids), len(w)), none)
        for n, at, m in queries:
            on = (at >= first) & (at < first + step)
            if n in rows and on.any():
                value[np.ix_(at[on] - first, rows[n][0])] = _whole(product(m[on], rows[n][1]))
        yield ids, w, value


NAMES = ["query_id", "vec_id", "similarity"]
SCHEMA = "query_id long, vec_id long, similarity double"


def _batch(query: np.ndarray, row: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    similarity = np.where(value == NAN, np.nan, value / SCALE)
    return pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(row, pa.int64()), pa.array(similarity, pa.float64(), mask=value == NONE)], names=NAMES)


def _ordered(slices: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Pairs by similarity, taken out of the slices: equal ones stand together, and columnar files take less than half the place where a block is full. A number holds similarity and place."""
    q, w = np.concatenate([x[0] for x in slices]), slices[0][1]
    keys, bits = np.empty(len(q) * len(w), np.int64), (len(q) * len(w)).bit_length()
    end = len(keys)
    while slices:
        value = slices.pop()[2].ravel()
        keys[end - len(value) : end] = value << bits | np.arange(end - len(value), end)
        end -= len(value)
    keys.sort()
    for first in range(0, len(keys), PART):
        key = keys[first : first + PART]
        place, value = key & (1 << bits) - 1, key >> bits
        a = place // len(w)
        a, b = q[a], w[place - a * len(w)]
        other = a != b
        yield _batch(a[other], b[other], value[other])


def similarities(dealt, product: Product = plain) -> DataFrame:
    """query_id, vec_id, similarity of every query and every other row; null where there is none, and 0 if the vectors are shifted."""
    none = 0 if product is shifted else NONE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for x in _slices(batches, product, none):
            if held and sum(y[2].size for y in held) + x[2].size > PAIRS:
                yield from _ordered(held)
            held.append(x)
        if held:
            yield from _ordered(held)

    return dealt.applyInArrow(run, SCHEMA)


def nearest(dealt) -> DataFrame:
    """query_id, vec_id, similarity of the most similar other row of every query, the least id at ties: a row a query and block goes to the next step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q, w, value in _slices(batches, plain, -NONE, by_id=True):
            value[(value == NAN) | (q[:, None] == w[None, :])] = -NONE
            at = value.argmax(axis=1)  # the first one: the least id
            best = value[np.arange(len(at)), at]
            yield _batch(q[best > -NONE], w[at][best > -NONE], best[best > -NONE])

    best = dealt.applyInArrow(run, SCHEMA).groupBy("query_id").agg(F.min(F.struct((-F.col("similarity")).alias("k"), "vec_id")).alias("b"))
    return best.select("query_id", F.col("b.vec_id").alias("vec_id"), (-F.col("b.k")).alias("similarity"))
