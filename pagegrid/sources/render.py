"""Statements drawn from the orders table: known rows as page objects, to test extraction on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagegrid.runtime import dealt

ROWS = 10
XS = [40, 120, 220, 280, 380]
TITLES = ["Date", "Description", "Status", "Amount"]


def statement_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, page_number, line (0 is the title row), texts: a document for each customer.

    A page's first line brings the titles along, so that the orders are numbered once.
    """
    orders = dealt(spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_custkey")
    n = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")) - 1
    amount = F.col("o_totalprice").cast("decimal(15,2)").cast("string")
    texts = F.array(F.col("o_orderdate").cast("date").cast("string"), F.col("o_orderpriority"), F.col("o_orderstatus"), amount)
    body = orders.select(F.col("o_custkey").cast("string").alias("doc_id"), n.alias("n"), texts.alias("texts"))
    row = F.struct((F.col("n") % ROWS + 1).cast("int").alias("line"), "texts")
    titles = F.struct(F.lit(0).alias("line"), F.array(*map(F.lit, TITLES)).alias("texts"))
    rows = F.when(F.col("n") % ROWS == 0, F.array(titles, row)).otherwise(F.array(row))
    return body.select("doc_id", (F.floor(F.col("n") / ROWS) + 1).cast("int").alias("page_number"), F.inline(rows))


def drawn_cells(rows: DataFrame) -> DataFrame:
    """doc_id, page_number, line, col, box, text."""
    boxes = rows.select("doc_id", "page_number", "line", F.posexplode("texts").alias("col", "text"))
    y0 = (760 - 20 * F.col("line")).cast("double")
    xs = F.array(*(F.lit(float(x)) for x in XS))
    return boxes.select("doc_id", "page_number", "line", "col", xs[F.col("col")].alias("x0"), y0.alias("y0"), xs[F.col("col") + 1].alias("x1"), (y0 + 20).alias("y1"), "text")


def render(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The frames pages, chars, segments and rects; chars are 5 points wide."""
    rows = statement_rows(spark, sf_dir)
    boxes = drawn_cells(rows)
    key = ["doc_id", "page_number"]
    seq = (F.col("line") * 4 + F.col("col")).cast("long")
    chars = boxes.select(*key, "line", "col", F.col("x0").alias("left"), F.col("y0").alias("base"), "text", F.explode(F.sequence(F.lit(1), F.length("text"))).alias("k"))
    chars = chars.select(
        *key, (seq * 1000 + F.col("k")).alias("seq"), F.substring(F.col("text"), F.col("k"), F.lit(1)).alias("text"),
        (F.col("left") + 5 * F.col("k")).alias("x0"), (F.col("base") + 5).alias("y0"), (F.col("left") + 5 * F.col("k") + 5).alias("x1"), (F.col("base") + 15).alias("y1"),
    )
    rects = boxes.select(*key, seq.alias("seq"), "x0", "y0", "x1", "y1")
    sides = F.array(
        F.struct("x0", "y0", "x1", F.col("y0").alias("y1")), F.struct(F.col("x1").alias("x0"), "y0", "x1", "y1"),
        F.struct("x0", F.col("y1").alias("y0"), "x1", "y1"), F.struct("x0", "y0", F.col("x0").alias("x1"), "y1"),
    )
    segments = rects.select(*key, "seq", F.posexplode(sides).alias("side", "s")).select(*key, (F.col("seq") * 4 + F.col("side")).alias("seq"), F.lit("edge").alias("kind"), "s.*")
    pages = rows.where("line = 0").select(*key, F.lit(612.0).alias("width"), F.lit(792.0).alias("height"))
    return {"pages": pages, "chars": chars, "segments": segments, "rects": rects}
