"""Ordered sequences: global alignment, marker partition, neighbours, promotion."""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MATCH, MISMATCH, FORBIDDEN, FORCED = 10, -10, -30, 100  # gains in twentieths; what stays alone loses one; a forced pair's row and column lose as much as its cell gains


CELLS = 4_000_000  # of the tables that are swept side by side


def _sweep(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moves (0 a pair, 1 an extra row, 2 a missing column) of the tables of many padded pairs of code arrays, an anti-diagonal of all of them at a time; in twentieths, so that ties are exact."""
    rows, n, m = len(a), a.shape[1], b.shape[1]
    best, moves = np.zeros((rows, n + 1, m + 1), np.int32), np.zeros((rows, n + 1, m + 1), np.int8)
    best[:, :, 0], best[:, 0, :] = -np.arange(n + 1), -np.arange(m + 1)
    moves[:, 1:, 0], moves[:, 0, 1:] = 1, 2
    for d in range(2, n + m + 1):
        i = np.arange(max(1, d - m), min(n, d - 1) + 1)
        j = d - i
        x = a[:, i - 1]
        pair = best[:, i - 1, j - 1] + np.where((x == b[:, j - 1]) & (x >= 0), MATCH, MISMATCH)
        extra, missing = best[:, i - 1, j] - 1, best[:, i, j - 1] - 1
        alone = np.maximum(extra, missing)
        best[:, i, j] = np.maximum(pair, alone)
        moves[:, i, j] = np.where(pair >= alone, 0, np.where(extra >= missing, 1, 2))
    return moves


def _walk(moves: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, i, j), from 1, of the pairs on the way back from the ends of all tables at once."""
    row, i, j, out = np.arange(len(n)), n.copy(), m.copy(), []
    while (open_ := (i > 0) | (j > 0)).any():
        row, i, j = row[open_], i[open_], j[open_]
        move = moves[row, i, j]
        hit = move == 0
        out.append((row[hit], i[hit], j[hit]))
        i, j = i - (move != 2), j - (move != 1)
    return tuple(np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*out) if out else ((), (), ())))


def align_paths(df: DataFrame, key: str) -> DataFrame:
    """The paired places i, j (from 1) of the short arrays a and b of each row: equal values gain 0.5, others lose 0.5, 0.05 are lost for what stays alone.

    At ties a pair goes before an extra row, that before a missing column. Whole tables are held for as many rows as CELLS allows; for long arrays use align_whole.
    """

    def run(batches):
        for batch in batches:
            lists = batch.column("a"), batch.column("b")
            codes = pa.concat_arrays([x.flatten() for x in lists]).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            size = np.stack([x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) for x in lists]).astype(np.int64)
            first = (np.cumsum(size) - size.ravel()).reshape(2, -1)
            order = np.argsort(size.max(0), kind="stable")
            step = 0
            while step < len(order):
                # as many rows as their padded tables have room for: rows are in the order of their longer side
                edge = size.max(0)[order[step:]] + 1
                part = order[step : step + max(1, int(np.searchsorted(np.arange(1, len(edge) + 1) * edge * edge, CELLS, side="right")))]
                step += len(part)
                padded = []
                for k in range(2):
                    at = np.arange(int(size[k, part].max()))
                    there = at < size[k, part][:, None]
                    padded.append(np.where(there, codes[np.where(there, first[k, part][:, None] + at, 0)] if len(codes) else -1, -1))
                row, i, j = _walk(_sweep(*padded), size[0, part], size[1, part])
                yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(part[row])), pa.array(i), pa.array(j)], names=[key, "i", "j"])

    return df.select(F.col(key).cast("long"), "a", "b").mapInArrow(run, f"{key} long, i long, j long")


class Anchors:
    """Gains that do not come from values: a sparse table over an alignment's cells.

    forbidden: cells that gain FORBIDDEN. forced: pairs (i, j) in their order of application: each one sets its row and its column to -FORCED
    and then its cell to FORCED, so a later pair of the same row or column takes an earlier one's gain away. Places are from 0; pairs and
    cells outside of the table are left out.
    """

    def __init__(self, n: int, m: int, forced=(), forbidden=()):
        inside = [(i, j) for i, j in forced if 0 <= i < n and 0 <= j < m]
        last_row, last_column = ({p[k]: t for t, p in enumerate(inside)} for k in (0, 1))
        self.rows = set(last_row)
        self.columns = np.array(sorted(last_column), np.int64)
        self.cells = {i: j for t, (i, j) in enumerate(inside) if last_row[i] == t == last_column[j]}
        self.barred: dict = {}
        for i, j in forbidden:
            if 0 <= i < n and 0 <= j < m:
                self.barred.setdefault(i, []).append(j)

    def set(self, i: int, gain: np.ndarray) -> None:
        """Change the gains of row i."""
        gain[self.barred.get(i, [])] = FORBIDDEN
        if i in self.rows:
            gain[:] = -FORCED
        gain[self.columns] = -FORCED
        if i in self.cells:
            gain[self.cells[i]] = FORCED


def _next_row(row: np.ndarray, code: int, b: np.ndarray, i: int, anchors: Anchors | None) -> tuple[np.ndarray, np.ndarray]:
    """The alignment's row behind `row`, in twentieths, and its moves: 0 a pair, 1 an extra row, 2 a missing column."""
    gain = np.where((b == code) & (b >= 0), MATCH, MISMATCH)
    if anchors:
        anchors.set(i, gain)
    pair, extra, steps = row[:-1] + gain, row[1:] - 1, np.arange(len(row))
    # each step to the right costs one twentieth: a running maximum of what is level with them
    out = np.maximum.accumulate(np.concatenate(([row[0] - 1], np.maximum(pair, extra))) + steps) - steps
    return out, np.where(out[1:] == pair, 0, np.where(out[1:] == extra, 1, 2)).astype(np.int8)


def align_codes(a: np.ndarray, b: np.ndarray, anchors: Anchors | None = None, path: bool = True) -> tuple[int, list[tuple[int, int]]]:
    """Score in twentieths and pairs of the best global alignment of two sequences of codes of any length; codes below 0 equal nothing.

    Equal codes gain 0.5, others lose 0.5, 0.05 are lost for what stays alone, anchored cells as Anchors says; at ties a pair goes before an extra row, that
    before a missing column; in whole numbers, so ties are exact.
    Only every sqrt(n)-th row is kept; the way back builds the moves of one block of rows at a time from it.
    """
    n, m, out = len(a), len(b), []
    block = max(1, int(np.ceil(np.sqrt(n))))
    row, kept = -np.arange(m + 1), []
    for i in range(n):
        if path and i % block == 0:
            kept.append(row)
        row = _next_row(row, a[i], b, i, anchors)[0]
    j = m
    for k in range(len(kept) - 1, -1, -1):
        begin, moves, at = k * block, [], kept[k]
        for i in range(begin, min(n, begin + block)):
            at, move = _next_row(at, a[i], b, i, anchors)
            moves.append(move)
        i = begin + len(moves)
        while i > begin:
            move = moves[i - begin - 1][j - 1] if j else 1
            if move == 0:
                out.append((i - 1, j - 1))
            i, j = i - (move != 2), j - (move != 1)
    return int(row[-1]), out[::-1]


def align_whole(df: DataFrame, key: str, paths: bool = False) -> DataFrame:
    """key and twentieths, or the paired places i, j (from 1), of the whole arrays a and b.

    Columns of df, if there are any: fa and fb, a forced pair (null or below 0: none); forced and forbidden, arrays of structs i, j (null: none),
    forced pairs in their order of application and cells that may not be paired, all from 0.
    """
    columns = [c for c in (key, "a", "b", "fa", "fb", "forced", "forbidden") if c in df.columns]
    names = [key, "i", "j"] if paths else [key, "twentieths"]

    def run(batches):
        for batch in batches:
            lists = batch.column("a"), batch.column("b")
            codes = pa.concat_arrays([x.flatten() for x in lists]).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(np.concatenate([x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) for x in lists])).tolist()
            n, begins = batch.num_rows, [0, *ends]
            cells = {c: [[(x["i"], x["j"]) for x in row or ()] for row in batch.column(c).to_pylist()] for c in ("forced", "forbidden") if c in columns}
            single = list(zip(batch.column("fa").to_pylist(), batch.column("fb").to_pylist())) if "fa" in columns else [(None, None)] * n
            for r, k in enumerate(batch.column(key).to_pylist()):
                a, b = codes[begins[r] : ends[r]], codes[begins[n + r] : ends[n + r]]
                forced = [single[r]] * (None not in single[r]) + cells.get("forced", {r: []})[r]
                forbidden = cells.get("forbidden", {r: []})[r]
                score, found = align_codes(a, b, Anchors(len(a), len(b), forced, forbidden) if forced or forbidden else None, paths)
                rows = [[k] * len(found), [i + 1 for i, _ in found], [j + 1 for _, j in found]] if paths else [[k], [score]]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in rows], names=names)

    return df.select(F.col(key).cast("long"), *columns[1:]).mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _range_least(values: np.ndarray, begin: np.ndarray, end: np.ndarray, none: int) -> np.ndarray:
    """The least of values[begin:end] for each pair, `none` for empty ones: from the least values of all stretches of 2, 4, 8, ... places."""
    out, size, step, table = np.full(len(begin), none), end - begin, 1, values
    while len(table):
        on = (size >= step) & (size < 2 * step)
        out[on] = np.minimum(table[begin[on]], table[end[on] - step])
        table = np.minimum(table[:-step], table[step:]) if len(table) > step else table[:0]
        step *= 2
    return out


def even_markers(seen: np.ndarray, total: int, parts: int) -> tuple[list[int], int] | None:
    """Numbers, from 1, and cost of the markers that part a total most evenly; seen: counts before each marker, rising.

    A part's cost |s_j - s_i - each| is s_j - each - s_i for the markers up to s_j - each and the negative of it behind them, so
    the best one before j is the first of a prefix's least cost - s_i and a stretch's least cost + s_i. Numbers of markers ride
    in the lower digits, so that the earliest one wins a tie.
    """
    m, each = len(seen), total // (parts + 1)
    if m < parts:
        return None
    place, none = np.arange(m), np.int64(1) << 60
    cost, ok, back = np.abs(seen - each), np.ones(m, bool), []
    near = np.minimum(np.searchsorted(seen, seen - each, side="right"), place)  # markers before j that lie up to s_j - each
    for _ in range(parts - 1):
        low, high = (np.where(ok, (cost + sign * seen) * m + place, none) for sign in (-1, 1))
        left = np.concatenate([[none], np.minimum.accumulate(low)])[near]
        right = _range_least(high, near, place, none)
        from_left = np.where(left < none, left // m + seen - each, none)
        from_right = np.where(right < none, right // m - seen + each, none)
        first = from_left <= from_right
        cost, ok = np.where(first, from_left, from_right), np.minimum(from_left, from_right) < none
        back.append(np.where(first, left, right) % m)
    cost = np.where(ok, cost + np.abs(total - seen - (total - parts * each)), none)
    path = [int(cost.argmin())]
    value = int(cost[path[0]])
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return [x + 1 for x in reversed(path)], value


def marker_partition(df: DataFrame, key: str, parts: int) -> DataFrame:
    """One marker for each of `parts` parts so that the counts between chosen markers come closest to even ones.

    df: key, markers (array of counts before each marker, rising in order), total. The last chosen marker is followed
    by what remains. Ties go to the smallest last marker, then to the earliest one before it, and so on. Null where
    there are too few markers.
    """
    schema = f"{key} long, chosen array<long>, cost long"

    def run(frames):
        for f in frames:
            found = [even_markers(np.asarray(seen, np.int64), int(total), parts) or (None, None) for seen, total in zip(f["markers"], f["total"])]
            yield pd.DataFrame({key: f[key], "chosen": [c for c, _ in found], "cost": pd.array([v for _, v in found], "Int64")})

    return df.select(key, "markers", "total").mapInPandas(run, schema)


def neighbours(df: DataFrame, keys: list[str], order: list[str], value: Column) -> DataFrame:
    """Adds before and after: the nearest non-null value among the rows before and behind."""
    # the rows behind are those before in the other direction: a frame that only grows
    ahead, behind = Window.partitionBy(*keys).orderBy(*order), Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    before, after = (F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)) for w in (ahead, behind))
    return df.withColumn("before", before).withColumn("after", after)


def promote(df: DataFrame, keys: list[str], order: list[str], weak: Column, anchored: Column) -> DataFrame:
    """Adds promoted: a weak row between two anchored ones; the first and the last row have no two neighbours."""
    w = Window.partitionBy(*keys).orderBy(*order)
    both = F.coalesce(F.lag("anchored_").over(w) & F.lead("anchored_").over(w), F.lit(False))
    return df.withColumn("anchored_", anchored).withColumn("promoted", weak & both).drop("anchored_")
