"""Results as text lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagegrid.schema import P


def _number(v: Column) -> Column:
    """Whole numbers without a point."""
    return F.when(v == F.floor(v), v.cast("long").cast("string")).otherwise(v.cast("string"))


def _box(number: Callable[[Column], Column]) -> Column:
    a, b, c, d = (number(F.col(n)) for n in ("x0", "y0", "x1", "y1"))
    return F.concat(F.lit("("), a, F.lit(", "), b, F.lit(")-("), c, F.lit(", "), d, F.lit(")"))


def page_cell_lines(cells: DataFrame) -> DataFrame:
    """P, cell_no, line: `Cell 0: Cell((51.0, 733.0)-(108.0, 748.0)), Text: '...'`; all numbers with a point."""
    return cells.select(*P, "cell_no", F.concat(F.lit("Cell "), F.col("cell_no"), F.lit(": Cell("), _box(lambda v: v.cast("double").cast("string")), F.lit("), Text: '"), F.col("text"), F.lit("'")).alias("line"))


def document_cell_lines(cells: DataFrame) -> DataFrame:
    """doc_id, ordinal, line: `Pg: 1, Cell 0: Cell(Pg:1, (x0, y0)-(x1, y1)), Text: '...'`; needs document_order."""
    page = F.col("page_number").cast("string")
    line = F.concat(F.lit("Pg: "), page, F.lit(", Cell "), F.col("ordinal"), F.lit(": Cell(Pg:"), page, F.lit(", "), _box(_number), F.lit("), Text: '"), F.col("text"), F.lit("'"))
    return cells.select("doc_id", "ordinal", line.alias("line"))


def header_block_lines(blocks: DataFrame, top: int = 5) -> DataFrame:
    """doc_id, ordinal, line: the file, a title, and two lines for each block."""
    n = F.col("rank") - 1
    bounds = F.format_string("Block %d vertical bounds (%.2f, %.2f) confidence: %.4f", n, "lower_y", "upper_y", "confidence")
    spoken = F.array_join(F.filter(F.transform("phrases", lambda p: p["text"]), lambda t: F.trim(t) != ""), ", ")
    body = blocks.select("doc_id", F.posexplode(F.array(bounds, F.concat(F.lit("Header phrases: "), spoken))).alias("i", "line"), "rank")
    head = F.array(F.concat(F.lit("PDF: "), F.col("doc_id")), F.lit(f"Top {top} detected header blocks with confidence scores:"))
    title = blocks.select("doc_id").distinct().select("doc_id", F.posexplode(head).alias("i", "line"), F.lit(0).alias("rank"))
    lines = body.unionByName(title)
    return lines.select("doc_id", (F.row_number().over(Window.partitionBy("doc_id").orderBy("rank", "i")) - 1).alias("ordinal"), "line")


def write_lines(lines: DataFrame, folder: str, order: str = "ordinal") -> None:
    """A folder of text files, one for each document, its lines in order."""
    lines.repartition("doc_id").sortWithinPartitions("doc_id", order).select("doc_id", "line").write.partitionBy("doc_id").mode("overwrite").text(folder)
