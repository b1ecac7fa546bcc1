"""Column expressions over coordinates. Origin bottom left, y up, in points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RTOL = 1e-5


def isclose(a: Column, b: Column, atol: float = 1e-8) -> Column:
    """|a - b| <= atol + 1e-5 |b|; the second argument scales."""
    return F.abs(a - b) <= F.lit(atol) + RTOL * F.abs(b)


def snap_to_grid(v: Column, dim: Column) -> Column:
    """The largest of 0, 1, ... int(dim)-1 not over v; v itself if there is none."""
    last = F.floor(dim).cast("double") - 1
    return F.when((v < 0) | (last < 0), v).otherwise(F.least(F.floor(v).cast("double"), last))


def bin_edge(v: Column, tol: float = 3.0) -> Column:
    """The nearest multiple of tol, halves to even."""
    return F.rint(v / tol) * tol


def orientation(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """vertical, else horizontal, else other; nothing but the relative tolerance."""
    return F.when(isclose(x0, x1, 0.0), "vertical").when(isclose(y0, y1, 0.0), "horizontal").otherwise("other")


def orientation_lattice(y0: Column, y1: Column) -> Column:
    """horizontal, or vertical for all else."""
    return F.when(isclose(y0, y1), "horizontal").otherwise("vertical")


def orientation_header(y0: Column, y1: Column, tol: float = 2.0) -> Column:
    return F.when(isclose(y0, y1, tol), "horizontal").otherwise("other")


def orientation_exact(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.when(x0 == x1, "vertical").when(y0 == y1, "horizontal").otherwise("other")


def rect_lines(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """The four sides as an array of (x0, y0, x1, y1): lower, right, upper, left."""
    sides = [(x0, y0, x1, y0), (x1, y0, x1, y1), (x0, y1, x1, y1), (x0, y0, x0, y1)]
    return F.array(*(F.struct(*(c.alias(n) for c, n in zip(s, ("x0", "y0", "x1", "y1")))) for s in sides))


def extend_line(x0: Column, y0: Column, x1: Column, y1: Column, by: float = 2.0) -> Column:
    """Longer by `by` at both ends; a line that is neither horizontal nor vertical becomes zeros."""
    flat, upright = isclose(y0, y1), isclose(x0, x1)
    zero = F.lit(0.0)
    ends = {
        "x0": F.when(flat, x0 - by).when(upright, x0).otherwise(zero),
        "y0": F.when(flat, y0).when(upright, y0 - by).otherwise(zero),
        "x1": F.when(flat, x1 + by).when(upright, x1).otherwise(zero),
        "y1": F.when(flat, y1).when(upright, y1 + by).otherwise(zero),
    }
    return F.struct(*(c.alias(n) for n, c in ends.items()))


def span_cover(span_start: Column, span_end: Column, start: Column, end: Column, tol: float = 3.0, ratio: float = 0.7) -> Column:
    """The span, longer by tol, covers at least `ratio` of the target."""
    overlap = F.greatest(F.lit(0.0), F.least(span_end + tol, end) - F.greatest(span_start - tol, start))
    return overlap >= (end - start) * ratio


def strict_link(a0: Column, a1: Column, b0: Column, b1: Column, tol: float = 3.0) -> Column:
    return (F.abs(a0 - b0) < tol) & (F.abs(a1 - b1) < tol)


def overlap_1d(a0: Column, a1: Column, b0: Column, b1: Column, tol: float) -> Column:
    return F.least(a1, b1) - F.greatest(a0, b0) >= -tol


def y_overlap(a0: Column, a1: Column, b0: Column, b1: Column, threshold: float = 0.0) -> Column:
    """The overlap is at least `threshold` of the lower height; false without a height."""
    overlap = F.greatest(F.lit(0.0), F.least(a1, b1) - F.greatest(a0, b0))
    height = F.least(a1 - a0, b1 - b0)
    return F.when(height > 0, overlap / height >= threshold).otherwise(False)


def shared_boundary(a: dict[str, Column], b: dict[str, Column], touch: float = 1e-6) -> Column:
    """Length of the side that a shares with b: right, left, upper, lower; else 0."""
    tall = F.greatest(F.lit(0.0), F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]))
    wide = F.greatest(F.lit(0.0), F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]))
    out = F.when(F.abs(a["x1"] - b["x0"]) < touch, tall).when(F.abs(a["x0"] - b["x1"]) < touch, tall)
    return out.when(F.abs(a["y1"] - b["y0"]) < touch, wide).when(F.abs(a["y0"] - b["y1"]) < touch, wide).otherwise(0.0)


def x_bucket(x0: Column) -> Column:
    return F.rint(x0 / 10) * 10


def raster(x: Column, y: Column, width: Column, height: Column) -> Column:
    """Row and column of a point in a bitmap of the page, within its bounds."""
    row = F.least(F.greatest(height - F.rint(y), F.lit(0.0)), height - 1)
    col = F.least(F.greatest(F.rint(x), F.lit(0.0)), width - 1)
    return F.struct(row.cast("int").alias("row"), col.cast("int").alias("col"))


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"^[\s\x1C-\x1F\x85 ]+|[\s\x1C-\x1F\x85 ]+$", "")
