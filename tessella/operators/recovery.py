"""Searches between neighbours: better places for doubtful pairs, and places for what nobody found, from a table of candidates.

A block is a sequence of wanted items j. Places are a column (pos, in reading order) and rows y0 to y1 in it; candidates are places
with their similarity to one wanted item. A search looks at the columns from the pair before to the pair behind, in theirs only below and above them,
and refuses when they are more than SPAN columns apart; columns with less room than a slot are passed over.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN = 12
FROM = 0.5  # a found place is more similar than this
PLACE = "struct<pos:bigint,y0:bigint,y1:bigint>"


def _place(pos, y0, y1) -> Column:
    return F.struct(F.col(pos).cast("long").alias("pos"), F.col(y0).cast("long").alias("y0"), F.col(y1).cast("long").alias("y1"))


def _allowed(c: Column, before: Column, behind: Column, top: int, bottom: int, slot: int) -> Column:
    """Whether a candidate lies between two places (null: none), neither refused nor without room."""
    low = F.when(c["pos"] == before["pos"], before["y1"]).otherwise(F.lit(top))
    high = F.when(c["pos"] == behind["pos"], behind["y0"]).otherwise(F.lit(bottom))
    inside = F.coalesce(c["pos"] >= before["pos"], F.lit(True)) & F.coalesce(c["pos"] <= behind["pos"], F.lit(True))
    near = F.coalesce(behind["pos"] - before["pos"] <= SPAN, F.lit(True))
    return near & inside & (high - low >= slot) & (c["y0"] >= low) & (c["y1"] <= high) & (c["sim"] > FROM)


def _best(cands: Column) -> Column:
    """The most similar one; the first in reading order at ties; null if there is none."""
    return F.array_min(F.transform(cands, lambda c: F.struct((-c["sim"]).alias("k"), c["pos"].alias("pos"), c["y0"].alias("y0"), c["y1"].alias("y1"))))


def _listed(candidates: DataFrame, keys: list[str]) -> DataFrame:
    return candidates.groupBy(*keys, "j").agg(F.collect_list(F.struct(F.col("pos").cast("long").alias("pos"), F.col("y0").cast("long").alias("y0"), F.col("y1").cast("long").alias("y1"), F.col("sim").cast("double").alias("sim"))).alias("cands"))


def replaced(pairs: DataFrame, candidates: DataFrame, keys: list[str], top: int, bottom: int, slot: int) -> DataFrame:
    """keys, j, pos, y0, y1, sim and moved of every pair, in their order.

    pairs: keys, j, pos, y0, y1, sim, doubtful; candidates: keys, j, pos, y0, y1, sim. A doubtful pair takes the best candidate of its item between its
    neighbours if that is more similar than the pair itself. The pair before is where an earlier search has put it, the one behind where it was: so a block, a bounded
    unit, is folded from its first pair on, carrying the last place.
    """
    w = Window.partitionBy(*keys).orderBy("j")
    rows = pairs.withColumn("behind", F.lead(_place("pos", "y0", "y1")).over(w)).join(_listed(candidates, keys), [*keys, "j"], "left")
    row = F.struct("j", _place("pos", "y0", "y1").alias("at"), F.col("sim").cast("double").alias("sim"), "doubtful", "behind", F.coalesce("cands", F.array().cast("array<struct<pos:bigint,y0:bigint,y1:bigint,sim:double>>")).alias("cands"))
    blocks = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("pairs"))
    done_type = f"array<struct<j:bigint,at:{PLACE},sim:double,moved:boolean>>"

    def step(state, p):
        found = _best(F.filter(p["cands"], lambda c: _allowed(c, state["last"], p["behind"], top, bottom, slot)))
        moved = F.coalesce(p["doubtful"] & (-found["k"] > p["sim"]), F.lit(False))
        at = F.when(moved, F.struct(found["pos"].alias("pos"), found["y0"].alias("y0"), found["y1"].alias("y1"))).otherwise(p["at"])
        new = F.struct(p["j"].cast("long").alias("j"), at.alias("at"), F.when(moved, -found["k"]).otherwise(p["sim"]).alias("sim"), moved.alias("moved"))
        return F.struct(at.cast(PLACE).alias("last"), F.array_append(state["done"], new).cast(done_type).alias("done"))

    start = F.struct(F.lit(None).cast(PLACE).alias("last"), F.array().cast(done_type).alias("done"))
    out = blocks.select(*keys, F.explode(F.aggregate("pairs", start, step)["done"]).alias("x"))
    return out.select(*keys, "x.j", "x.at.pos", "x.at.y0", "x.at.y1", "x.sim", "x.moved")


def recovered(missing: DataFrame, pairs: DataFrame, candidates: DataFrame, keys: list[str], top: int, bottom: int, slot: int) -> DataFrame:
    """keys, j and the found pos, y0, y1, sim (null: none) of every missing item (keys, j), between the pairs (keys, j, pos, y0, y1, sim), wherever searches have put them."""
    both = pairs.select(*keys, "j", _place("pos", "y0", "y1").alias("at")).unionByName(missing.select(*keys, "j", F.lit(None).cast(PLACE).alias("at")))
    ahead, back = Window.partitionBy(*keys).orderBy("j"), Window.partitionBy(*keys).orderBy(F.desc("j"))
    near = both.select(*keys, "j", "at", *[F.last("at", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias(c) for w, c in ((ahead, "before"), (back, "behind"))]).filter("at is null")
    cands = candidates.select(*keys, "j", F.struct(F.col("pos").cast("long").alias("pos"), F.col("y0").cast("long").alias("y0"), F.col("y1").cast("long").alias("y1"), F.col("sim").cast("double").alias("sim")).alias("c"))
    hit = near.join(cands, [*keys, "j"], "left")
    c = F.col("c")
    good = F.when(c.isNotNull() & _allowed(c, F.col("before"), F.col("behind"), top, bottom, slot), F.struct((-c["sim"]).alias("k"), c["pos"].alias("pos"), c["y0"].alias("y0"), c["y1"].alias("y1")))
    best = hit.groupBy(*keys, "j").agg(F.min(good).alias("b"))
    return best.select(*keys, "j", "b.pos", "b.y0", "b.y1", (-F.col("b.k")).alias("sim"))
