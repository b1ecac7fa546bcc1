"""A query for each operator over the driver's data, and DuckDB SQL with the same result.

Page objects are drawn from the orders table, so the SQL can tell what must be found
from the source rows, or from the drawing's rule, without any of the operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagegrid.functions import geometry as G
from pagegrid.operators import cells as C
from pagegrid.operators import graph, headers, intervals, words
from pagegrid.operators import lattice as L
from pagegrid.plans.document import Documents, LatticePages, header_blocks
from pagegrid.runtime import attach_workers
from pagegrid.schema import BOX, P
from pagegrid.sources import render as R
from pagegrid.sources import sinks
from pagegrid.sources.page_objects import page_subset

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            attach_workers(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ints(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("int") for n in names or BOX})


#: The drawn statements in SQL: r has their lines (0 is the titles), boxes their cells, pages how many lines.
DRAWN = """
    WITH o AS (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS n FROM orders
    ), body AS (
        SELECT CAST(o_custkey AS VARCHAR) AS doc_id, CAST(n // 10 + 1 AS INTEGER) AS page_number, CAST(n % 10 + 1 AS INTEGER) AS line,
               [CAST(CAST(o_orderdate AS DATE) AS VARCHAR), o_orderpriority, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS VARCHAR)] AS texts FROM o
    ), r AS (
        SELECT * FROM body UNION ALL SELECT DISTINCT doc_id, page_number, 0, ['Date', 'Description', 'Status', 'Amount'] FROM body
    ), pages AS (
        SELECT doc_id, page_number, CAST(count(*) AS INTEGER) AS n FROM r GROUP BY ALL
    ), boxes AS (
        SELECT doc_id, page_number, line, CAST(c AS INTEGER) AS col, CAST([40, 120, 220, 280][c + 1] AS INTEGER) AS x0, 760 - 20 * line AS y0,
               CAST([120, 220, 280, 380][c + 1] AS INTEGER) AS x1, 780 - 20 * line AS y1, texts[c + 1] AS text FROM r, range(4) AS t(c)
    ), xs AS (SELECT CAST(i AS INTEGER) AS i, CAST([40, 120, 220, 280, 380][i + 1] AS INTEGER) AS x FROM range(5) AS t(i)
    ), ys AS (SELECT doc_id, page_number, n, CAST(k AS INTEGER) AS k, CAST(780 - 20 * k AS INTEGER) AS y FROM pages, range(12) AS t(k) WHERE k <= n)
"""
CHARS_SQL = """
    SELECT doc_id, page_number, (line * 4 + col) * 1000 + k AS seq, substr(text, k, 1) AS text, CAST(x0 + 5 * k AS INTEGER) AS x0, y0 + 5 AS y0,
           CAST(x0 + 5 * k + 5 AS INTEGER) AS x1, y0 + 15 AS y1
    FROM (SELECT *, unnest(range(1, length(text) + 1)) AS k FROM boxes)
"""


@query(DRAWN + CHARS_SQL)
def render_chars(spark, sf_dir):
    return _ints(R.render(spark, sf_dir)["chars"])


@query(DRAWN + CHARS_SQL)
def read_chars(spark, sf_dir):
    """Each char twice in the stream; the first stays."""
    chars = R.render(spark, sf_dir)["chars"]
    again = chars.withColumn("seq", F.col("seq") + 10_000_000)
    return _ints(C.read_objects(chars.unionByName(again), ["text", *BOX]).select(*P, "seq", "text", *BOX))


@query(DRAWN + "SELECT doc_id, page_number, line, x0, y0, x1, y1, text FROM boxes WHERE page_number IN (1, 3)")
def pages_subset(spark, sf_dir):
    frames = page_subset({"cells": R.drawn_cells(R.statement_rows(spark, sf_dir))}, [0, 2])
    return _ints(frames["cells"].select(*P, "line", *BOX, "text"))


# Scalar expressions, on lines made of numbers of the events table.

LINES = """
    WITH lines AS (
        SELECT event_id, (event_id % 100) * 1.0::DOUBLE AS x0, (event_id % 100) * 1.0::DOUBLE + (event_id % 3) * 0.0004::DOUBLE AS x1, value AS y0, value + (event_id % 2) * 1.25::DOUBLE AS y1 FROM events
    )
"""


def _lines(spark, sf_dir):
    e = _table(spark, sf_dir, "events")
    x0 = (F.col("event_id") % 100).cast("double")
    return e.select("event_id", x0.alias("x0"), F.col("value").alias("y0"), (x0 + (F.col("event_id") % 3) * F.lit(0.0004)).alias("x1"), (F.col("value") + (F.col("event_id") % 2) * F.lit(1.25)).alias("y1"))


@query(
    LINES
    + """
    SELECT event_id, CASE WHEN abs(x0 - x1) <= 1e-5 * abs(x1) THEN 'vertical' WHEN abs(y0 - y1) <= 1e-5 * abs(y1) THEN 'horizontal' ELSE 'other' END AS ruled,
           CASE WHEN abs(y0 - y1) <= 1e-8 + 1e-5 * abs(y1) THEN 'horizontal' ELSE 'vertical' END AS lattice,
           CASE WHEN abs(y0 - y1) <= 2 + 1e-5 * abs(y1) THEN 'horizontal' ELSE 'other' END AS header,
           CASE WHEN x0 = x1 THEN 'vertical' WHEN y0 = y1 THEN 'horizontal' ELSE 'other' END AS exact FROM lines
"""
)
def orientation(spark, sf_dir):
    x0, y0, x1, y1 = map(F.col, BOX)
    return _lines(spark, sf_dir).select("event_id", G.orientation(x0, y0, x1, y1).alias("ruled"), G.orientation_lattice(y0, y1).alias("lattice"), G.orientation_header(y0, y1).alias("header"), G.orientation_exact(x0, y0, x1, y1).alias("exact"))


@query(
    LINES
    + """
    SELECT event_id, CASE WHEN y0 < 0 THEN y0 ELSE least(floor(y0), 61) END AS snapped, CAST(round_even(y0 / 3, 0) AS DOUBLE) * 3 AS bin, CAST(round_even(x0 / 10, 0) AS DOUBLE) * 10 AS bucket,
           CAST(greatest(least(greatest(62 - CAST(round_even(y0, 0) AS DOUBLE), 0), 61), 0) AS INTEGER) AS pixel_row, CAST(least(greatest(CAST(round_even(x0, 0) AS DOUBLE), 0), 49) AS INTEGER) AS pixel_col FROM lines
"""
)
def snap_and_bin(spark, sf_dir):
    pixel = G.raster(F.col("x0"), F.col("y0"), F.lit(50.0), F.lit(62.0))
    return _lines(spark, sf_dir).select(
        "event_id", G.snap_to_grid(F.col("y0"), F.lit(62.4)).alias("snapped"), G.bin_edge(F.col("y0")).alias("bin"), G.x_bucket(F.col("x0")).alias("bucket"), pixel["row"].alias("pixel_row"), pixel["col"].alias("pixel_col")
    )


@query(
    LINES
    + """
    , marked AS (SELECT *, abs(y0 - y1) <= 1e-8 + 1e-5 * abs(y1) AS h, abs(x0 - x1) <= 1e-8 + 1e-5 * abs(x1) AS v FROM lines)
    SELECT event_id, round(CASE WHEN h THEN x0 - 2 WHEN v THEN x0 ELSE 0 END, 6) AS x0, round(CASE WHEN h THEN y0 WHEN v THEN y0 - 2 ELSE 0 END, 6) AS y0,
           round(CASE WHEN h THEN x1 + 2 WHEN v THEN x1 ELSE 0 END, 6) AS x1, round(CASE WHEN h THEN y1 WHEN v THEN y1 + 2 ELSE 0 END, 6) AS y1 FROM marked
"""
)
def extend_lines(spark, sf_dir):
    return _lines(spark, sf_dir).select("event_id", G.extend_line(*map(F.col, BOX)).alias("s")).select("event_id", *(F.round(f"s.{c}", 6).alias(c) for c in BOX))


@query(
    LINES
    + """
    SELECT event_id, greatest(0, least(y1 + 3, x0 + 9) - greatest(y0 - 3, x0)) >= 9 * 0.7 AS covers, abs(x0 - y0) < 3 AND abs(x1 - y1) < 3 AS linked,
           least(x1, y1) - greatest(x0, y0) >= -3 AS overlaps, CASE WHEN least(x1 - x0, y1 - y0) > 0 THEN greatest(0, least(x1, y1) - greatest(x0, y0)) / least(x1 - x0, y1 - y0) >= 0.5 ELSE false END AS half FROM lines
"""
)
def span_tests(spark, sf_dir):
    x0, y0, x1, y1 = map(F.col, BOX)
    return _lines(spark, sf_dir).select(
        "event_id", G.span_cover(y0, y1, x0, x0 + 9).alias("covers"), G.strict_link(x0, x1, y0, y1).alias("linked"), G.overlap_1d(x0, x1, y0, y1, 3.0).alias("overlaps"), G.y_overlap(x0, x1, y0, y1, 0.5).alias("half")
    )


@query(
    DRAWN
    + """
    , sides AS (SELECT *, unnest([1, -1, 0, 0]) AS over_col, unnest([0, 0, 1, -1]) AS over_line FROM boxes)
    SELECT a.doc_id, a.page_number, a.line, a.col, b.line AS line2, b.col AS col2, CAST(CASE WHEN over_line = 0 THEN 20 ELSE a.x1 - a.x0 END AS INTEGER) AS shared
    FROM sides a JOIN boxes b ON a.doc_id = b.doc_id AND a.page_number = b.page_number AND b.line = a.line + over_line AND b.col = a.col + over_col
"""
)
def shared_boundary(spark, sf_dir):
    a = R.drawn_cells(R.statement_rows(spark, sf_dir))
    b = a.select(*P, F.col("line").alias("line2"), F.col("col").alias("col2"), *(F.col(c).alias(f"b_{c}") for c in BOX))
    pairs = a.join(b, P).where((F.col("line") != F.col("line2")) | (F.col("col") != F.col("col2")))
    shared = G.shared_boundary({c: F.col(c) for c in BOX}, {c: F.col(f"b_{c}") for c in BOX})
    return _ints(pairs.select(*P, "line", "col", "line2", "col2", shared.alias("shared")).where("shared > 0"), "shared")


@query(
    DRAWN
    + """
    SELECT doc_id, page_number, x0, y0, x1, y0 AS y1 FROM boxes UNION SELECT doc_id, page_number, x1, y0, x1, y1 FROM boxes
    UNION SELECT doc_id, page_number, x0, y1, x1, y1 FROM boxes UNION SELECT doc_id, page_number, x0, y0, x0, y1 FROM boxes
"""
)
def rect_to_lines(spark, sf_dir):
    frames = R.render(spark, sf_dir)
    return _ints(L.all_lines(frames["segments"], frames["rects"]).select(*P, *BOX))


# Ruled pages.

_drawn: dict[tuple, Documents] = {}


def _documents(spark, sf_dir) -> Documents:
    """The drawn statements; their cells are found once in a session, as long as the orders stay as they are."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/orders.parquet")
    file = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at)
    key = (spark.sparkContext.applicationId, sf_dir, file.getModificationTime(), file.getLen())
    if key not in _drawn:
        _drawn[key] = Documents(R.render(spark, sf_dir))
    return _drawn[key]


def _segments(spark, sf_dir):
    return C.read_segments(R.render(spark, sf_dir)["segments"])


@query(DRAWN + "SELECT doc_id, page_number, x, y FROM ys, xs")
def intersections(spark, sf_dir):
    return _ints(C.intersections(_segments(spark, sf_dir)), "x", "y")


SPANS = """
    , spans AS (
        SELECT doc_id, page_number, b.i - a.i AS w, d.k - c.k AS h, (b.x - a.x) * (c.y - d.y) AS area, a.x AS x1, d.y AS y1, b.x AS x2, c.y AS y2
        FROM xs a JOIN xs b ON a.i < b.i, ys c JOIN ys d USING (doc_id, page_number) WHERE c.k < d.k
    )
"""


@query(DRAWN + SPANS + "SELECT doc_id, page_number, x1, y1, x2, y2 FROM spans")
def rectangles(spark, sf_dir):
    return _ints(C.rectangles(C.intersections(_segments(spark, sf_dir))), "x1", "y1", "x2", "y2")


@query(DRAWN + "SELECT doc_id, page_number, x0 AS x1, y0 AS y1, x1 AS x2, y1 AS y2 FROM boxes")
def level0_rectangles(spark, sf_dir):
    return _ints(C.cell_boxes(C.intersections(_segments(spark, sf_dir))), "x1", "y1", "x2", "y2")


@query(DRAWN + SPANS + "SELECT doc_id, page_number, x1, y1, x2, y2 FROM spans WHERE w = 1 OR h = 1")
def empty_rectangles(spark, sf_dir):
    points = C.intersections(_segments(spark, sf_dir))
    return _ints(C.empty_rectangles(C.rectangles(points), points), "x1", "y1", "x2", "y2")


@query(DRAWN + SPANS + "SELECT doc_id, page_number, x1, y1, x2, y2, CAST(w + h - 2 AS INTEGER) AS level FROM spans")
def rectangle_levels(spark, sf_dir):
    return _ints(C.levels(C.rectangles(C.intersections(_segments(spark, sf_dir)))), "x1", "y1", "x2", "y2")


@query(DRAWN + "SELECT doc_id, page_number, x0, y0, x1, y1 FROM boxes")
def corner_cells(spark, sf_dir):
    return _ints(C.corner_cells(_segments(spark, sf_dir)))


@query(DRAWN + "SELECT doc_id, page_number, x0, y0, x1, y1, text FROM boxes")
def rect_cells(spark, sf_dir):
    frames = R.render(spark, sf_dir)
    return _ints(C.rect_cells(frames["rects"], frames["chars"]))


@query(DRAWN + "SELECT doc_id, page_number, x0, y0, x1, y1, 792 - y0 AS row0, x0 AS col0, 792 - y1 AS row1, x1 AS col1 FROM boxes")
def raster_corners(spark, sf_dir):
    frames = R.render(spark, sf_dir)
    found = C.raster_corners(frames["rects"], frames["pages"])
    return _ints(found.select(*P, *BOX, *(F.col(f"corner{i}.{n}").alias(f"{n}{i}") for i in (0, 1) for n in ("row", "col"))))


@query(DRAWN + "SELECT doc_id, page_number, CAST(row_number() OVER (PARTITION BY doc_id, page_number ORDER BY x0, y0 DESC) - 1 AS INTEGER) AS cell_no, x0, y0, x1, y1, x1 - x0 AS width, y1 - y0 AS height, text FROM boxes")
def cells_roundtrip(spark, sf_dir):
    return _ints(_documents(spark, sf_dir).found_cells().drop("ordinal"), *BOX, "width", "height", "cell_no")


ORDINAL = "CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page_number, y0 DESC, x0) - 1 AS INTEGER) AS ordinal"


@query(DRAWN + f"SELECT doc_id, page_number, {ORDINAL}, x0, y0, text FROM boxes")
def document_cells(spark, sf_dir):
    return _ints(_documents(spark, sf_dir).found_cells().select(*P, "ordinal", "x0", "y0", "text"), "x0", "y0", "ordinal")


@query(DRAWN + f"SELECT doc_id, ordinal, format('Pg: {{}}, Cell {{}}: Cell(Pg:{{}}, ({{}}, {{}})-({{}}, {{}})), Text: ''{{}}''', page_number, ordinal, page_number, x0, y0, x1, y1, text) AS line FROM (SELECT *, {ORDINAL} FROM boxes)")
def cell_sink_lines(spark, sf_dir):
    return _ints(sinks.document_cell_lines(_documents(spark, sf_dir).found_cells()), "ordinal")


@query(DRAWN + "SELECT doc_id, page_number, line AS group_no, 40 AS x0, 760 - 20 * line AS y0, 380 AS x1, 780 - 20 * line AS y1, 4 AS length, array_to_string(texts, '|') AS texts FROM r")
def rows(spark, sf_dir):
    return _ints(_documents(spark, sf_dir).rows.select(*P, "group_no", *BOX, "length", F.array_join("texts", "|").alias("texts")), *BOX, "group_no")


@query(DRAWN + "SELECT doc_id, page_number, col AS group_no, x0, min(y0) AS y0, x1, max(y1) AS y1, CAST(count(*) AS INTEGER) AS length, string_agg(text, '|' ORDER BY y0) AS texts FROM boxes GROUP BY doc_id, page_number, col, x0, x1")
def columns(spark, sf_dir):
    return _ints(_documents(spark, sf_dir).columns.select(*P, "group_no", *BOX, "length", F.array_join("texts", "|").alias("texts")), *BOX, "group_no")


@query(DRAWN + "SELECT DISTINCT doc_id, 1 AS page_number, 0 AS group_no, 1.0::DOUBLE AS max_similarity FROM pages")
def header_row(spark, sf_dir):
    found = _documents(spark, sf_dir).header_row
    return _ints(found.select(*P, "group_no", F.round("max_similarity", 6).alias("max_similarity")), "group_no")


@query(DRAWN + "SELECT DISTINCT doc_id, 4 AS num_cells, '40,120,220,280' AS column_x, '80,100,60,100' AS column_width FROM pages")
def table_structure(spark, sf_dir):
    found = _documents(spark, sf_dir).table_structure
    return found.select("doc_id", "num_cells", *(F.array_join(F.col(c).cast("array<int>"), ",").alias(c) for c in ("column_x", "column_width")))


@query(DRAWN + "SELECT doc_id, 'Date|Description|Status|Amount' AS header, string_agg(array_to_string(texts, '|'), chr(10) ORDER BY page_number, line) AS lines FROM r WHERE page_number > 1 OR line > 0 GROUP BY doc_id")
def document_body(spark, sf_dir):
    found = _documents(spark, sf_dir).body()
    lines = F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), "\n")
    return found.select("doc_id", F.array_join("header", "|").alias("header"), lines.alias("lines"))


# Intervals and clusters, on plain numbers of the lineitem table.

ISLANDS = "sum(new) OVER (PARTITION BY k ORDER BY a, b ROWS UNBOUNDED PRECEDING)"


@query(
    f"""
    WITH i AS (SELECT l_orderkey AS k, l_quantity * 10 AS a, l_quantity * 10 + l_linenumber * 3 AS b FROM lineitem),
    m AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY k ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 3 THEN 0 ELSE 1 END AS new FROM i),
    g AS (SELECT *, {ISLANDS} AS n FROM m)
    SELECT k, min(a) AS a, max(b) AS b FROM g GROUP BY k, n
"""
)
def merge_intervals(spark, sf_dir):
    a = F.col("l_quantity") * 10
    return intervals.merge_intervals(_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), a.alias("a"), (a + F.col("l_linenumber") * 3).alias("b")), ["k"], "a", "b")


SQUASH = """
    WITH v AS (SELECT DISTINCT l_orderkey AS k, l_quantity * 2 AS y FROM lineitem),
    m AS (SELECT *, CASE WHEN y - lag(y) OVER (PARTITION BY k ORDER BY y) <= 3 THEN 0 ELSE 1 END AS new FROM v),
    g AS (SELECT *, sum(new) OVER (PARTITION BY k ORDER BY y) AS n FROM m),
    s AS (SELECT k, y, n, avg(y) OVER (PARTITION BY k, n) AS squashed FROM g)
"""


@query(SQUASH + "SELECT k, y, CAST(n AS BIGINT) AS cluster, round(squashed, 6) AS squashed FROM s")
def squash_coords(spark, sf_dir):
    values = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), (F.col("l_quantity") * 2).alias("y"))
    return intervals.squash(values, ["k"], "y").select("k", "y", "cluster", F.round("squashed", 6).alias("squashed"))


@query(
    SQUASH
    + """
    , l AS (SELECT l_orderkey AS k, squashed AS y, l_partkey % 500 AS a, l_partkey % 500 + l_linenumber * 10 AS b, n FROM lineitem JOIN s ON s.k = l_orderkey AND s.y = l_quantity * 2),
    lm AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY k, n ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 3 THEN 0 ELSE 1 END AS new FROM l),
    lg AS (SELECT *, sum(new) OVER (PARTITION BY k, n ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS p FROM lm)
    SELECT k, CAST(min(a) AS DOUBLE) AS x0, round(y, 6) AS y0, CAST(max(b) AS DOUBLE) AS x1 FROM lg GROUP BY k, n, y, p
"""
)
def cluster_lines(spark, sf_dir):
    y, x = F.col("l_quantity") * 2, (F.col("l_partkey") % 500).cast("double")
    lines = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), x.alias("x0"), y.alias("y0"), (x + F.col("l_linenumber") * 10).alias("x1"), y.alias("y1"))
    return intervals.cluster_lines(lines, "y", keys=["k"]).select("k", "x0", F.round("y0", 6).alias("y0"), "x1")


POINTS = """
    WITH RECURSIVE p AS (SELECT l_orderkey AS k, l_quantity AS x, l_linenumber * 2.0::DOUBLE AS y, count(*) AS weight FROM lineitem GROUP BY ALL),
    e AS (SELECT a.k, a.x, a.y, b.x AS x2, b.y AS y2 FROM p a JOIN p b USING (k) WHERE (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 9),
    c AS (SELECT k, x, y, x AS cx, y AS cy FROM p UNION SELECT e.k, e.x2, e.y2, c.cx, c.cy FROM c JOIN e USING (k, x, y)),
    f AS (SELECT k, x, y, min((cx, cy)) AS component FROM c GROUP BY k, x, y)
"""


def _points(spark, sf_dir):
    return _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_quantity").alias("x"), (F.col("l_linenumber") * F.lit(2.0)).alias("y"))


@query(POINTS + "SELECT k, x, y, weight, component[1] AS component_x, component[2] AS component_y FROM f JOIN p USING (k, x, y)")
def epsilon_clusters(spark, sf_dir):
    return graph.epsilon_clusters(_points(spark, sf_dir), ["k"])


@query(POINTS + "SELECT k, x, y, round(sum(x * weight) OVER g / sum(weight) OVER g, 6) AS cx, round(sum(y * weight) OVER g / sum(weight) OVER g, 6) AS cy FROM f JOIN p USING (k, x, y) WINDOW g AS (PARTITION BY k, component)")
def centroids(spark, sf_dir):
    return graph.centroids(_points(spark, sf_dir), ["k"]).select("k", "x", "y", F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"))


# Lattice pages.


@query(
    DRAWN
    + """
    SELECT doc_id, page_number, 38 AS x0, y AS y0, 382 AS x1, y AS y1, 'horizontal' AS orientation FROM ys
    UNION ALL SELECT doc_id, page_number, x, 778 - 20 * n, x, 782, 'vertical' FROM pages, xs
"""
)
def lattice_lines(spark, sf_dir):
    return _ints(LatticePages(R.render(spark, sf_dir)).lines.select(*P, *BOX, "orientation"))


@query(
    DRAWN
    + """
    , xe AS (SELECT x AS x0, lead(x) OVER (ORDER BY x) AS x1 FROM (SELECT x FROM xs UNION ALL SELECT 38 UNION ALL SELECT 382)),
    yv AS (SELECT doc_id, page_number, y FROM ys UNION ALL SELECT doc_id, page_number, 782 FROM pages UNION ALL SELECT doc_id, page_number, 778 - 20 * n FROM pages),
    ye AS (SELECT doc_id, page_number, y AS y0, lead(y) OVER (PARTITION BY doc_id, page_number ORDER BY y) AS y1 FROM yv)
    SELECT ye.doc_id, ye.page_number, xe.x0, ye.y0, xe.x1, ye.y1, coalesce(text, '') AS text
    FROM ye JOIN xe ON xe.x1 IS NOT NULL AND ye.y1 IS NOT NULL LEFT JOIN boxes b ON b.doc_id = ye.doc_id AND b.page_number = ye.page_number AND b.x0 = xe.x0 AND b.y0 = ye.y0 AND b.x1 = xe.x1 AND b.y1 = ye.y1
"""
)
def lattice_cells(spark, sf_dir):
    return _ints(LatticePages(R.render(spark, sf_dir)).found_cells.select(*P, *BOX, "text"))


@query(
    DRAWN
    + """
    SELECT doc_id, page_number, CAST(col * n + n - 1 - line AS INTEGER) AS cell_no, CASE WHEN col = 0 THEN 38 ELSE x0 END AS x0, CASE WHEN line = n - 1 THEN y0 - 2 ELSE y0 END AS y0,
           x1, CASE WHEN line = 0 THEN y1 + 2 ELSE y1 END AS y1, text FROM boxes JOIN pages USING (doc_id, page_number)
    UNION ALL SELECT doc_id, page_number, 4 * n, 380, 778 - 20 * n, 382, 782, '' FROM pages
"""
)
def merge_small_cells(spark, sf_dir):
    """Lines reach 2 points over the grid: the cells there go into their neighbours, but for one down the right side."""
    return _ints(LatticePages(R.render(spark, sf_dir)).merged_cells().select(*P, "cell_no", *BOX, "text"))


def _numbered(spark, sf_dir):
    found = R.drawn_cells(R.statement_rows(spark, sf_dir))
    bottom = F.max("line").over(C.Window.partitionBy(*P))
    return found.select(*P, (F.col("col") * (bottom + 1) + bottom - F.col("line")).alias("cell_no"), *BOX, "text")


LINKS = """
    , numbered AS (SELECT b.*, n, col * n + n - 1 - line AS cell_no FROM boxes b JOIN pages USING (doc_id, page_number))
"""


@query(
    DRAWN
    + LINKS
    + """
    , sides AS (SELECT *, unnest([1, -1, 0, 0]) AS over_col, unnest([0, 0, 1, -1]) AS over_line, unnest(['right', 'left', 'top', 'bottom']) AS direction FROM numbered)
    SELECT a.doc_id, a.page_number, a.cell_no, a.direction, b.cell_no AS neighbour_no
    FROM sides a JOIN numbered b ON a.doc_id = b.doc_id AND a.page_number = b.page_number AND b.line = a.line + over_line AND b.col = a.col + over_col
"""
)
def cell_links(spark, sf_dir):
    return L.link_cells(_numbered(spark, sf_dir))


def _grouped(df: DataFrame) -> DataFrame:
    return _ints(df.select(*P, *BOX, "length", F.array_join("texts", "|").alias("texts")))


@query(DRAWN + "SELECT doc_id, page_number, min(x0) AS x0, y0, max(x1) AS x1, y1, CAST(count(*) AS INTEGER) AS length, string_agg(text, '|' ORDER BY col) AS texts FROM boxes GROUP BY doc_id, page_number, y0, y1")
def lattice_rows(spark, sf_dir):
    cells = _numbered(spark, sf_dir)
    return _grouped(L.rows(cells, L.link_cells(cells)))


@query(DRAWN + "SELECT doc_id, page_number, x0, min(y0) AS y0, x1, max(y1) AS y1, CAST(count(*) AS INTEGER) AS length, string_agg(text, '|' ORDER BY y0) AS texts FROM boxes GROUP BY doc_id, page_number, x0, x1")
def lattice_columns(spark, sf_dir):
    cells = _numbered(spark, sf_dir)
    return _grouped(L.columns(cells, L.link_cells(cells)))


@query(DRAWN + "SELECT doc_id, page_number, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, CAST(count(*) AS INTEGER) AS length, string_agg(text, '|' ORDER BY col, y0) AS texts FROM boxes GROUP BY doc_id, page_number")
def lattice_grids(spark, sf_dir):
    cells = _numbered(spark, sf_dir)
    return _grouped(L.grids(cells, L.link_cells(cells)))


# Words, phrases and headers.

WORDS = "SELECT doc_id, page_number, n - 1 - line AS band_no, col AS ordinal, text, x0 + 5 AS x0, y0 + 5 AS y0, CAST(x0 + 5 + 5 * length(text) AS INTEGER) AS x1, y0 + 15 AS y1 FROM boxes JOIN pages USING (doc_id, page_number)"


def _words(spark, sf_dir):
    frames = R.render(spark, sf_dir)
    return words.words(words.band_chars(frames["chars"], words.bands(frames["segments"])))


@query(DRAWN + WORDS)
def band_words(spark, sf_dir):
    return _ints(_words(spark, sf_dir), *BOX, "band_no", "ordinal")


@query(DRAWN + WORDS)
def band_phrases(spark, sf_dir):
    return _ints(words.phrases(words.logical_cells(_words(spark, sf_dir)), 1.0), *BOX, "band_no", "ordinal")


def _keyword_sql(words_: list[str]) -> str:
    return ", ".join("('" + w.replace("'", "''") + "')" for w in words_)


def _grams_sql(name: str, source: str) -> str:
    return f"""
    {name}_c AS (SELECT text, substr(' ' || text || ' ', i, 3) AS g, count(*) AS c FROM (SELECT text, unnest(range(1, greatest(length(text), 1) + 1)) AS i FROM (SELECT DISTINCT text FROM {source} WHERE text <> '')) GROUP BY ALL),
    {name} AS (SELECT text, g, c / sqrt(sum(c * c) OVER (PARTITION BY text)) AS w FROM {name}_c)"""


@query(
    f"WITH kw AS (SELECT * FROM (VALUES {_keyword_sql(headers.KEYWORDS)}) AS t(text)), parts AS (SELECT lower(p_name) AS text FROM part UNION SELECT lower(p_type) FROM part), {_grams_sql('a', 'parts')}, {_grams_sql('b', 'kw')}"
    " SELECT a.text, b.text AS keyword, round(sum(a.w * b.w), 6) AS similarity FROM a JOIN b USING (g) GROUP BY ALL"
)
def keyword_similarity(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    texts = part.select(F.lower("p_name").alias("text")).union(part.select(F.lower("p_type")))
    found = headers.keyword_similarity(texts, headers.keywords(spark))
    return found.select("text", "keyword", F.round("similarity", 6).alias("similarity"))


BLOCKS = (
    DRAWN
    + f", kw AS (SELECT * FROM (VALUES {_keyword_sql(headers.KEYWORDS + headers.BLOCK_KEYWORDS)}) AS t(text)), {_grams_sql('a', 'boxes')}, {_grams_sql('b', 'kw')}"
    + """
    , pairs AS (SELECT a.text, b.text AS keyword, sum(a.w * b.w) AS s FROM a JOIN b USING (g) GROUP BY ALL),
    best AS (SELECT text, max(s) AS s FROM pairs GROUP BY text),
    scored AS (SELECT doc_id, page_number, line, avg(coalesce(s, 0)) AS confidence, string_agg(text, ', ' ORDER BY col) AS phrases FROM boxes LEFT JOIN best USING (text) GROUP BY ALL),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY round(confidence, 9) DESC, page_number, line DESC) AS INTEGER) AS rank FROM scored),
    top AS (SELECT doc_id, page_number, rank, 760 - 20 * line AS lower_y, 780 - 20 * line AS upper_y, round(confidence, 6) AS confidence, phrases FROM ranked WHERE rank <= 5)
"""
)


@query(BLOCKS + "SELECT * FROM top")
def header_blocks_top5(spark, sf_dir):
    found = header_blocks(R.render(spark, sf_dir))
    texts = F.array_join(F.transform("phrases", lambda p: p["text"]), ", ")
    return _ints(found.select(*P, "rank", "lower_y", "upper_y", F.round("confidence", 6).alias("confidence"), texts.alias("phrases")), "lower_y", "upper_y", "rank")


@query(
    BLOCKS
    + """
    SELECT doc_id, CAST(2 * rank AS INTEGER) AS ordinal, printf('Block %d vertical bounds (%.2f, %.2f) confidence: %.4f', rank - 1, CAST(lower_y AS DOUBLE), CAST(upper_y AS DOUBLE), confidence) AS line FROM top
    UNION ALL SELECT doc_id, CAST(2 * rank + 1 AS INTEGER), 'Header phrases: ' || phrases FROM top
    UNION ALL SELECT DISTINCT doc_id, 0, 'PDF: ' || doc_id FROM top UNION ALL SELECT DISTINCT doc_id, 1, 'Top 5 detected header blocks with confidence scores:' FROM top
"""
)
def header_sink_lines(spark, sf_dir):
    blocks = header_blocks(R.render(spark, sf_dir)).withColumn("confidence", F.round("confidence", 6))
    return _ints(sinks.header_block_lines(blocks), "ordinal")


@query(
    """
    WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    m AS (SELECT label, i, avg(v[i]) AS x FROM (SELECT label, v, unnest(range(1, len(v) + 1)) AS i FROM e) GROUP BY label, i),
    means AS (SELECT label, list(x ORDER BY i) AS mean FROM m GROUP BY label)
    SELECT vec_id, label, round(list_cosine_similarity(v, mean), 6) AS similarity FROM e JOIN means USING (label)
"""
)
def embedding_similarity(spark, sf_dir):
    """Each vector against the mean of all vectors of its label."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    means = vectors.select("label", F.posexplode("v").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("x"))
    means = means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("mean"))
    return vectors.join(means, "label").select("vec_id", "label", F.round(headers.cosine(F.col("v"), F.col("mean")), 6).alias("similarity"))


@query(DRAWN + LINKS + "SELECT doc_id, page_number, CAST(cell_no AS INTEGER) AS cell_no, format('Cell {}: Cell(({}, {})-({}, {})), Text: {}{}{}', cell_no, CAST(x0 AS DOUBLE)::VARCHAR, CAST(y0 AS DOUBLE)::VARCHAR, CAST(x1 AS DOUBLE)::VARCHAR, CAST(y1 AS DOUBLE)::VARCHAR, chr(39), text, chr(39)) AS line FROM numbered")
def page_sink_lines(spark, sf_dir):
    return _ints(sinks.page_cell_lines(_numbered(spark, sf_dir)), "cell_no")


@query(
    DRAWN
    + """
    SELECT 'row' AS kind, doc_id, page_number, line AS group_no, array_to_string(texts, '|') AS texts FROM r WHERE page_number = 2
    UNION ALL SELECT 'column', doc_id, page_number, col, string_agg(text, '|' ORDER BY y0) FROM boxes WHERE page_number = 1 GROUP BY doc_id, page_number, col
"""
)
def page_filter(spark, sf_dir):
    """Rows of second pages and columns of first ones."""
    found = _documents(spark, sf_dir)
    both = [x.select(F.lit(kind).alias("kind"), *P, F.col("group_no").cast("int").alias("group_no"), F.array_join("texts", "|").alias("texts")) for kind, x in (("row", found.get_rows(2)), ("column", found.get_columns(1)))]
    return both[0].unionByName(both[1])


@query(DRAWN + "SELECT doc_id, page_number, CAST(4 * n AS BIGINT) AS cells, CAST(n AS BIGINT) AS rows, CAST(4 AS BIGINT) AS columns FROM pages")
def page_counts(spark, sf_dir):
    return _documents(spark, sf_dir).counts()


@query(
    DRAWN
    + """
    , d AS (SELECT doc_id, CAST(doc_id AS BIGINT) AS k, count(*) AS pages FROM pages GROUP BY doc_id)
    SELECT doc_id, 'header' AS stage, 'no header row' AS message FROM d WHERE k % 3 = 0
    UNION ALL SELECT doc_id, 'chars', format('{} objects without coordinates', pages) FROM d WHERE k % 5 = 0 AND k % 3 <> 0
"""
)
def document_errors(spark, sf_dir):
    """Every third document has no titles; every fifth of the others has lost a coordinate of each page's first char."""
    frames = R.render(spark, sf_dir)
    key = F.col("doc_id").cast("long")
    chars = frames["chars"].where(~((key % 3 == 0) & (F.col("seq") < 4000)))
    x0 = F.when(~((key % 5 == 0) & (F.col("seq") == 1)), F.col("x0"))
    return Documents(frames | {"chars": chars.withColumn("x0", x0)}).errors()
