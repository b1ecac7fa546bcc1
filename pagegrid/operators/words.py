"""Words, logical cells and phrases of the bands between horizontal edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagegrid.functions.geometry import orientation_header, strip, x_bucket
from pagegrid.operators.cells import joined_text, strip_of, strips
from pagegrid.operators.intervals import island
from pagegrid.runtime import dealt
from pagegrid.schema import BOX, P

BAND = [*P, "band_no"]


def bands(segments: DataFrame, tol: float = 2.0) -> DataFrame:
    """P, band_no, lower_y, upper_y: between consecutive heights of horizontal lines."""
    flat = segments.where(orientation_header(F.col("y0"), F.col("y1"), tol) == "horizontal")
    ys = flat.select(*P, F.col("y0").alias("y")).union(flat.select(*P, "y1")).where("y is not null").distinct()
    over = Window.partitionBy(*P).orderBy("y")
    out = ys.select(*P, (F.row_number().over(over) - 1).alias("band_no"), F.col("y").alias("lower_y"), F.lead("y").over(over).alias("upper_y"))
    return out.where("upper_y is not null")


def band_chars(chars: DataFrame, of: DataFrame) -> DataFrame:
    """Chars that lie in a band, with its number, dealt by bands, so that all that follows in a band needs no shuffle.

    They meet strip by strip, as chars and cells do; a char that is upside down may be in
    several strips and bands.
    """
    c = chars.select(*P, "seq", "text", *BOX).withColumn("c_first", strip_of(F.least("y0", "y1"))).withColumn("_strip", F.explode(F.sequence("c_first", strip_of(F.col("y0")))))
    reach = strips(F.col("lower_y"), F.col("upper_y"))
    b = of.withColumn("first", F.array_min(reach)).withColumn("_strip", F.explode(reach))
    inside = (F.col("y0") >= F.col("lower_y")) & (F.col("y1") <= F.col("upper_y")) & (F.col("_strip") == F.greatest("first", "c_first"))
    return dealt(c.join(b, [*P, "_strip"]).where(inside).select(*BAND, "seq", "text", *BOX), *BAND)


def words(chars: DataFrame, tol: float = 2.0, keys: list[str] = BAND) -> DataFrame:
    """keys, ordinal, text, box: chars from the top, by x0; a word ends at a step in x of more than tol.

    x1 is the last char's, not the greatest.
    """
    over = Window.partitionBy(*keys).orderBy(F.desc("y0"), "x0", "seq")
    last = F.lag("x1").over(over)
    marked = chars.withColumn("_i", F.row_number().over(over)).withColumn("_new", last.isNull() | (F.abs(F.col("x0") - last) > tol))
    marked = marked.withColumn("ordinal", island(F.col("_new"), over) - 1)
    return marked.groupBy(*keys, "ordinal").agg(
        strip(joined_text(F.col("_i"), F.col("text"))).alias("text"),
        F.min_by("x0", "_i").alias("x0"), F.min("y0").alias("y0"), F.max_by("x1", "_i").alias("x1"), F.max("y1").alias("y1"),
    ).select(*keys, "ordinal", "text", *BOX)


def _merged(df: DataFrame, by: list[str]) -> DataFrame:
    """One box for each group: texts from the top, by x0, with spaces; a single one as it is."""
    order = F.struct(-F.col("y0"), F.col("x0"), F.col("ordinal"))
    return df.groupBy(*by).agg(
        joined_text(order, F.col("text"), " ").alias("text"), F.min("ordinal").alias("ordinal"),
        F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"),
    )


def logical_cells(found: DataFrame, x_gap: float = 6.0, y_proximity: float = 5.0, keys: list[str] = BAND) -> DataFrame:
    """Words merged along x up to a gap of x_gap, then down a column of nearby x0.

    All words with a height count as one line, as any two of them do with an overlap of
    nothing; words without one stay alone.
    """
    tall = F.col("y1") > F.col("y0")
    lined = found.withColumn("_line", F.when(tall, F.lit(-1)).otherwise(F.col("ordinal")))
    over = Window.partitionBy(*keys, "_line").orderBy("x0", "ordinal")
    last = F.lag("x1").over(over)
    lined = lined.withColumn("_new", last.isNull() | (F.col("x0") - last > x_gap)).withColumn("_g", island(F.col("_new"), over))
    cells = _merged(lined, [*keys, "_line", "_g"]).withColumn("_key", x_bucket(F.col("x0")))
    over = Window.partitionBy(*keys, "_key").orderBy(F.desc("y0"), "x0", "ordinal")
    last = F.lag("y1").over(over)
    cells = cells.withColumn("_new", last.isNull() | (F.col("y0") - last > y_proximity)).withColumn("_g", island(F.col("_new"), over))
    return _merged(cells, [*keys, "_key", "_g"]).select(*keys, "ordinal", "text", *BOX)


def phrases(found: DataFrame, tol: float = 8.0, keys: list[str] = BAND) -> DataFrame:
    """keys, ordinal, text, box: logical cells by x0; a phrase ends at a step of more than tol."""
    over = Window.partitionBy(*keys).orderBy("x0", "ordinal")
    last = F.lag("x1").over(over)
    marked = found.withColumn("_i", F.row_number().over(over)).withColumn("_new", last.isNull() | (F.abs(F.col("x0") - last) > tol))
    marked = marked.withColumn("_n", island(F.col("_new"), over) - 1)
    return marked.groupBy(*keys, F.col("_n").alias("ordinal")).agg(
        strip(joined_text(F.col("_i"), F.col("text"), " ")).alias("text"),
        F.min_by("x0", "_i").alias("x0"), F.min("y0").alias("y0"), F.max_by("x1", "_i").alias("x1"), F.max("y1").alias("y1"),
    ).select(*keys, "ordinal", "text", *BOX)
