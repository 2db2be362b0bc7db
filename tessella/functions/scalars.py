"""Column expressions shared by the operators."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(ts: str) -> Column:
    """Microseconds from 1970 of a zone-less timestamp, whatever the session's time zone."""
    d = f"({ts} - TIMESTAMP_NTZ'1970-01-01 00:00:00')"
    return F.expr(f"cast(extract(DAY FROM {d}) AS BIGINT) * 86400000000 + extract(HOUR FROM {d}) * 3600000000L + extract(MINUTE FROM {d}) * 60000000L + cast(extract(SECOND FROM {d}) * 1000000 AS BIGINT)")


def r6(c: Column) -> Column:
    return F.round(c.cast("double"), 6)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def unit(v: Column) -> Column:
    """A vector moved to mean 0 and scaled to length 1; null where its length is then 0.

    Sum and length are bound by the folds' last steps, so that no element computes them again.
    """
    n = F.size(v)

    def scale(total):
        mean = total / n
        return F.aggregate(v, F.lit(0.0), lambda q, x: q + (x - mean) * (x - mean), lambda q: F.when(q > 0, F.transform(v, lambda x: (x - mean) / F.sqrt(q))))

    return F.aggregate(v, F.lit(0.0), lambda s, x: s + x, scale)


def shift(v: Column, by: int) -> Column:
    """A vector moved by some places; places without a value are 0."""
    return F.transform(v, lambda x, i: F.coalesce(F.when(i - by >= 0, F.get(v, i - by)), F.lit(0.0)))


def overlap_shorter(s1, e1, s2, e2) -> Column:
    """Common length over that of the shorter interval, which counts as 1 at least."""
    return F.greatest(F.least(e1, e2) - F.greatest(s1, s2), F.lit(0)) / F.greatest(F.least(e1 - s1, e2 - s2), F.lit(1))


def interval_iou(s1, e1, s2, e2) -> Column:
    common = F.greatest(F.least(e1, e2) - F.greatest(s1, s2), F.lit(0))
    return common / F.greatest((e1 - s1) + (e2 - s2) - common, F.lit(1))


def iou(p, q) -> Column:
    """Of two boxes with the fields x0, y0, x1, y1 (structs, or dicts of columns); the union counts as 1 at least."""
    w = F.greatest(F.least(p["x1"], q["x1"]) - F.greatest(p["x0"], q["x0"]), F.lit(0))
    h = F.greatest(F.least(p["y1"], q["y1"]) - F.greatest(p["y0"], q["y0"]), F.lit(0))
    area = lambda z: (z["x1"] - z["x0"]) * (z["y1"] - z["y0"])
    return w * h / F.greatest(area(p) + area(q) - w * h, F.lit(1))


def box_iou(a: str, b: str) -> Column:
    """Of two boxes with the columns x0, y0, x1, y1 behind the prefixes a and b."""
    return iou(*({k: F.col(f"{z}{k}") for k in ("x0", "y0", "x1", "y1")} for z in (a, b)))


def slugify(c: Column) -> Column:
    """A title as a file name: no namespace before the first colon, no .pdf or .djvu, other signs to one underscore, 80 characters."""
    bare = F.regexp_replace(F.regexp_replace(c, r"^[^:]*:", ""), r"(?i)\.(pdf|djvu)$", "")
    return F.left(F.regexp_replace(F.regexp_replace(bare, r"[^\p{L}\p{N}_-]+", "_"), r"^_+|_+$", ""), F.lit(80))


def hex5(c: Column) -> Column:
    return F.format_string("%05X", c)


def code_point(c: Column) -> Column:
    """The number that a hexadecimal text stands for."""
    return F.conv(c, 16, 10).cast("int")


def character(cp: Column) -> Column:
    """The character of a code point, supplementary planes too."""
    return F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")
