"""Gaps and islands: interval merge and one-dimensional chain clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagegrid.functions.geometry import isclose
from pagegrid.schema import P


def island(new: Column, over) -> Column:
    """Number of the island that a row is in; new: whether it starts one."""
    return F.sum(F.when(new, 1).otherwise(0)).over(over.rowsBetween(Window.unboundedPreceding, 0))


def merge_intervals(df: DataFrame, keys: list[str], start: str, end: str, tol: float = 3.0) -> DataFrame:
    """Intervals of a key that overlap or lie within tol become one: keys, start, end."""
    over = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(over.rowsBetween(Window.unboundedPreceding, -1))
    new = reach.isNull() | (F.col(start) > reach + tol)
    marked = df.withColumn("_new", new).withColumn("_n", island(F.col("_new"), over))
    return marked.groupBy(*keys, "_n").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_n")


def merge_lines(lines: DataFrame, axis: str, tol: float = 3.0, keys: list[str] = P) -> DataFrame:
    """Merge horizontal lines of equal y (axis "y") or vertical ones of equal x (axis "x"); others go."""
    along = "x" if axis == "y" else "y"
    straight = lines.where(isclose(F.col(f"{axis}0"), F.col(f"{axis}1")))
    merged = merge_intervals(straight.select(*keys, f"{axis}0", f"{along}0", f"{along}1"), [*keys, f"{axis}0"], f"{along}0", f"{along}1", tol)
    return merged.withColumn(f"{axis}1", F.col(f"{axis}0")).select(*keys, "x0", "y0", "x1", "y1")


def squash(df: DataFrame, keys: list[str], value: str, tol: float = 3.0, first_seen: str | None = None) -> DataFrame:
    """keys, value, cluster, squashed: distinct values chained by gaps up to tol, and each chain's mean.

    first_seen: a column with the value's first ordinal; then the value that came first
    makes the first group with those that chain on from it in order, as one old pipeline did.
    """
    values = df.select(*keys, value).distinct() if first_seen is None else df.groupBy(*keys, value).agg(F.min(first_seen).alias("_seen"))
    by_key = Window.partitionBy(*keys)
    if first_seen is None:
        over = by_key.orderBy(value)
    else:
        values = values.withColumn("_later", F.row_number().over(by_key.orderBy(F.asc_nulls_last("_seen"), value)) > 1)
        over = by_key.orderBy("_later", value)
    prior = F.lag(value).over(over)
    values = values.withColumn("_new", prior.isNull() | (F.abs(F.col(value) - prior) > tol)).withColumn("cluster", island(F.col("_new"), over))
    return values.withColumn("squashed", F.avg(value).over(Window.partitionBy(*keys, "cluster"))).select(*keys, value, "cluster", "squashed")


def cluster_lines(lines: DataFrame, axis: str, tol: float = 3.0, keys: list[str] = P, first_seen: str | None = None) -> DataFrame:
    """Lines of nearby y (axis "y") or x become one at the mean of the distinct coordinates, merged along the other axis."""
    along = "x" if axis == "y" else "y"
    straight = lines.where(isclose(F.col(f"{axis}0"), F.col(f"{axis}1")))
    groups = squash(straight, keys, f"{axis}0", tol, first_seen)
    placed = straight.join(groups, [*keys, f"{axis}0"]).select(*keys, "cluster", "squashed", f"{along}0", f"{along}1")
    merged = merge_intervals(placed, [*keys, "cluster", "squashed"], f"{along}0", f"{along}1", tol)
    return merged.withColumns({f"{axis}0": F.col("squashed"), f"{axis}1": F.col("squashed")}).select(*keys, "x0", "y0", "x1", "y1")
