"""Best-fit packing of token sequences by a configuration linear program.

Every document is tokenised, closed by an end id and, if longer than a sequence, cut into whole
sequences behind a shorter first piece. The histogram of piece lengths, of at most `capacity`
numbers, is all that the driver sees. Over it, the linear program of configurations (how often to use each
way of filling a sequence, in parts) is solved by multiplicative weights: lengths that are served
get lighter, and a knapsack dynamic program prices fillings for the weights. The weights give a lower bound, and so
the gap of the fractional solution. Its fillings are used whole times, rounded down; the few pieces that this leaves, about half a sequence a
filling, are packed by a bounded knapsack over what is left.

Pieces find their places by their rank among the pieces of their length: ranks come from counts per
(length, salt), so no length, however common, meets in one task.

Defined results: a null text is an empty one and gives a piece of one end id; repeated rows are packed
each; an empty table gives no rows; a piece of just `capacity` tokens fills a sequence.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella import session
from tessella.llm import textops as T

SPECIAL = "<|endoftext|>"  # one token of the tokenizers file wherever a text holds it; white space around it stays
SPECIAL_ID = 50256
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def encode(texts: list, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and how many each has, as the tokenizers file gives them: stretches between special tokens are encoded by themselves."""
    parts = [(t or "").split(SPECIAL) for t in texts]
    flat, counts = T.encode_chunk([x for part in parts for x in part], path)
    many = np.fromiter(map(len, parts), np.int64, len(parts))
    if len(counts) > len(parts):
        last = np.zeros(len(counts), bool)
        last[np.cumsum(many) - 1] = True
        flat = np.insert(flat, np.cumsum(counts)[~last], SPECIAL_ID)
    return flat, T.sums(counts, many) + many - 1


def pieces(docs: DataFrame, path: str, capacity: int = 1024, end: int = 2) -> DataFrame:
    """The pieces of every row of docs(doc_id, text): their place in the document, their ids' CRC-32."""

    def run(batches):
        for batch in T.chunks(batches):
            flat, counts = encode(batch.column("text").to_pylist(), path)
            n = counts + 1
            whole = np.empty(int(n.sum()), np.uint32)
            stop = np.cumsum(n) - 1
            keep = np.ones(len(whole), bool)
            keep[stop] = False
            whole[keep], whole[stop] = flat, end
            k = -(-n // capacity)
            head = n - (k - 1) * capacity
            row = np.repeat(np.arange(len(n)), k)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)
            begin = np.where(piece == 0, 0, head[row] + (piece - 1) * capacity)
            length = np.where(piece == 0, head[row], capacity)
            at, raw = (begin + (np.cumsum(n) - n)[row]).tolist(), memoryview(whole.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * (a + m)]) for a, m in zip(at, length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(begin, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def price(weight: np.ndarray, capacity: int, limit: np.ndarray) -> np.ndarray:
    """The filling of most weight: how often each length is used, limit[l] times at most. weight[l] <= 0 where length l is not wanted.

    A bounded knapsack over the capacity: the copies of a length are items of 1, 2, 4, ... of them and the rest.
    """
    best = np.zeros(capacity + 1)
    items = []
    for size in np.flatnonzero((weight > 0) & (limit > 0))[::-1].tolist():
        left, copies = min(int(limit[size]), capacity // size), 1
        while left > 0:
            k = min(copies, left)
            value = best[: capacity + 1 - k * size] + k * weight[size]
            better = value > best[k * size :] + 1e-12
            np.copyto(best[k * size :], value, where=better)
            items.append((size, k, better))
            left, copies = left - k, 2 * copies
    use, c = np.zeros(capacity + 1, np.int64), capacity
    for size, k, better in reversed(items):
        if c >= k * size and better[c - k * size]:
            use[size] += k
            c -= k * size
    return use


def values(weight: np.ndarray, capacity: int) -> np.ndarray:
    """The most weight that fits into each room up to the capacity, with any number of each length; weight[l] <= 0 where length l is not wanted."""
    best = np.zeros(capacity + 1)
    back = np.zeros(capacity + 1)  # best, from the capacity down
    for c in range(1, capacity + 1):
        best[c] = max(best[c - 1], (weight[1 : c + 1] + back[capacity - c + 1 :]).max())
        back[capacity - c] = best[c]
    return best


def filled(weight: np.ndarray, best: np.ndarray, first: int, capacity: int) -> tuple[dict[int, int], float]:
    """A filling that holds the length `first` and what the values of the rooms make best beside it, and its weight."""
    use, room, total = {first: 1}, capacity - first, weight[first]
    while room:
        k = int((weight[1 : room + 1] + best[room - 1 :: -1]).argmax()) + 1
        if weight[k] <= 0:
            break
        use[k] = use.get(k, 0) + 1
        room, total = room - k, total + weight[k]
    return use, total


def program(demand: np.ndarray, capacity: int, step: float = 0.1, rate: float = 0.1, lead: float = 1.0, slack: float = 0.001) -> tuple[dict[tuple, float], float]:
    """The configuration program's fractional solution and a lower bound for it: {filling: times} that serve the demand exactly; a filling is a tuple of (length, pieces).

    The fewest sequences, in parts, whose fillings serve the demand: a filling comes in when a knapsack prices it, and weights (the
    dual values) stand for the demand. A length's weight is its size, times exp(-rate) for each whole demand that was served; long lengths are
    taken to be `lead` times their size behind, so that what is left at the end is short and fills any room. A knapsack gives the value of
    every room; then the length that lags most, of those in a filling whose weight is by its values within `slack` of the best (and indeed within twice that), gets that filling, for `step` of the
    demand of its scarcest length or what is open of it. Weights only fall, so the values stay an upper bound until no such filling is left and
    the knapsack is solved again. A length served in full drops out. Each filling serves `step` of a length or its rest, so there are (1 + 1 / step) times
    the lengths of them at most, whatever the corpus.

    The weights over the value of the best filling are a feasible dual solution: the demand times it is a lower bound for any packing.
    """
    size = np.arange(capacity + 1) / capacity
    served = np.where(demand > 0, 0.0, 1.0)
    found: dict[tuple, float] = {}
    bound = float(demand @ size)  # the sizes themselves are a dual solution
    while (served < 1).any():
        weight = np.where(served < 1, size * np.exp(-rate * (served - lead * size)), -1.0)
        best = values(weight, capacity)
        bound = max(bound, float(demand @ np.maximum(weight, 0)) / best[capacity])
        asked, least = served < 1, (1 - slack) * best[capacity]
        while True:
            near = asked & (weight + best[::-1] >= least)
            if not near.any():
                break
            first = int(np.where(near, served - lead * size, np.inf).argmin())
            use, total = filled(weight, best, first, capacity)
            if total < (1 - 2 * slack) * best[capacity]:  # the values are too old for it
                asked[first] = False
                continue
            k, n = np.fromiter(use, np.int64), np.fromiter(use.values(), np.int64)
            times = float((np.minimum(step, 1 - served[k]) * demand[k] / n).min())
            key = tuple(sorted(use.items()))
            found[key] = found.get(key, 0.0) + times
            served[k] += n * times / demand[k]
            served[k[served[k] > 1 - 1e-9]] = 1
            weight[k] = np.where(served[k] < 1, size[k] * np.exp(-rate * (served[k] - lead * size[k])), -1.0)
            asked &= served < 1
    return found, bound


def rest(demand: np.ndarray, capacity: int, prefer: float = 0.2) -> list[tuple[np.ndarray, int]]:
    """(filling, times) for the pieces that whole parts of the program leave: the fullest sequence that these pieces make, as often as they allow, and so on.

    Of equally full sequences the one of longer pieces goes first (by a part `prefer` of their squares), as short ones fill any room later.
    """
    size = np.arange(len(demand)) / capacity
    weight, open_, out = size * (1 + prefer * size), demand.astype(np.int64), []
    while open_.any():
        use = price(weight, capacity, open_)
        on = use > 0
        times = int((open_[on] // use[on]).min())
        open_[on] -= use[on] * times
        out.append((use, times))
    return out


def solve(demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """(filling, times) that cover the demand exactly: the program's fillings rounded down to whole times, the rest filled piece by piece."""
    left, out = demand.astype(np.int64), []
    for filling, times in program(left, capacity)[0].items():
        use = np.zeros(len(demand), np.int64)
        for k, n in filling:
            use[k] = n
        on = use > 0
        whole = min(int(times + 1e-9), int((left[on] // use[on]).min()))
        if whole:
            left[on] -= use[on] * whole
            out.append((use, whole))
    return out + rest(left, capacity)


def plan(demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """(filling, times) that cover the demand exactly; demand[l]: the number of pieces of length l."""
    left, out = demand.astype(np.int64).copy(), []
    if left[capacity]:
        full = np.zeros(capacity + 1, np.int64)
        full[capacity] = 1
        out.append((full, int(left[capacity])))
        left[capacity] = 0
    return out + solve(left, capacity)


def places(fillings: list[tuple[np.ndarray, int]]) -> list[tuple]:
    """Rows (length, from rank, to rank, first sequence, pieces a sequence, first offset): where pieces of a length go."""
    rows, used, sequence = [], {}, 0
    for use, times in fillings:
        offset = 0
        for size in np.flatnonzero(use)[::-1].tolist():
            k = int(use[size])
            first = used.get(size, 0)
            rows.append((size, first, first + k * times, sequence, k, offset))
            used[size] = first + k * times
            offset += k * size
        sequence += times
    return rows


def pack(docs: DataFrame, path: str, capacity: int = 1024, end: int = 2, salts: int = 0) -> DataFrame:
    """PIECES and sequence_id, offset for every piece of docs(doc_id, text)."""
    spark = docs.sparkSession
    salts = salts or 2 * session.parts(spark)
    salted = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "start"), F.lit(salts)).cast("int")
    cut = session.cut(pieces(docs, path, capacity, end).withColumn("salt", salted))
    counts = session.cut(cut.groupBy("length", "salt").agg(F.count("*").alias("n")))
    demand = np.zeros(capacity + 1, np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():  # one row a length: `capacity` at most
        demand[length] = n
    rows = places(plan(demand, capacity))
    spots = spark.createDataFrame(rows, "length long, from_rank long, to_rank long, first_sequence long, per_sequence long, first_offset long")
    base = counts.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("base"))
    ranked = cut.withColumn("place", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")).cast("long") - 1)
    ranked = ranked.join(base, ["length", "salt"]).withColumn("rank", F.col("base") + F.col("place"))
    # the places are bounded by the capacity and the rounds of the program, not by the corpus: some thousand rows
    spots = F.broadcast(spots.withColumnRenamed("length", "of"))
    put = ranked.join(spots, (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank")))
    nth = F.col("rank") - F.col("from_rank")
    return put.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.floor(nth / F.col("per_sequence"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + F.pmod(nth, F.col("per_sequence")) * F.col("length")).cast("long").alias("offset"),
    )
