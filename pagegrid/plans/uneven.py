"""Queries on unevenly drawn pages, and on what goes wrong: gaps, strays, slivers, short lines, words without a grid, broken files."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagegrid.operators import cells as C
from pagegrid.operators import headers, intervals, words
from pagegrid.operators import lattice as L
from pagegrid.plans.document import header_blocks
from pagegrid.plans.queries import DRAWN, _grams_sql, _grouped, _ints, _keyword_sql, _table, query
from pagegrid.schema import BOX, RECTS, P, validate_schema
from pagegrid.sources import uneven as U
from pagegrid.sources.page_objects import decode
from pagegrid.sources.render import statement_rows

GROUP_COLUMNS = "CAST(row_number() OVER (PARTITION BY doc_id, page_number ORDER BY {order}) - 1 AS INTEGER) AS group_no, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, CAST(count(*) AS INTEGER) AS length"
BROKEN = DRAWN + ", kept AS (SELECT * FROM boxes WHERE NOT (col = 2 AND line % 3 = 1)) "


def _groups(spark, sf_dir, kind):
    cells = U.broken_cells(statement_rows(spark, sf_dir)).withColumn("cell_no", F.col("col") * 100 + F.col("line"))
    return _ints(C.groups(cells, kind).select(*P, "group_no", *BOX, "length", F.array_join("texts", "|").alias("texts")), *BOX, "group_no")


@query(
    BROKEN
    + f"""
    SELECT doc_id, page_number, {GROUP_COLUMNS.format(order="max(y0) DESC, min(x0)")}, string_agg(text, '|' ORDER BY col) AS texts
    FROM (SELECT *, col - row_number() OVER (PARTITION BY doc_id, page_number, line ORDER BY col) AS island FROM kept) GROUP BY doc_id, page_number, line, island
"""
)
def rows_with_gaps(spark, sf_dir):
    return _groups(spark, sf_dir, "row")


@query(
    BROKEN
    + f"""
    SELECT doc_id, page_number, {GROUP_COLUMNS.format(order="min(x0), min(y0)")}, string_agg(text, '|' ORDER BY y0) AS texts
    FROM (SELECT *, line - row_number() OVER (PARTITION BY doc_id, page_number, col ORDER BY line) AS island FROM kept) GROUP BY doc_id, page_number, col, island
"""
)
def columns_with_gaps(spark, sf_dir):
    return _groups(spark, sf_dir, "column")


@query(DRAWN + "SELECT doc_id, page_number, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, CAST(count(*) AS INTEGER) AS length, string_agg(text, '|' ORDER BY col, y0) AS texts FROM boxes WHERE line <= 3 GROUP BY doc_id, page_number")
def grids_without_strays(spark, sf_dir):
    cells = U.stray_cells(statement_rows(spark, sf_dir)).withColumn("cell_no", F.col("col") * 100 + 50 - F.col("line"))
    return _grouped(L.grids(cells, L.link_cells(cells)))


@query(
    DRAWN
    + """
    , wide AS (SELECT b.*, n, lead(col) OVER (PARTITION BY doc_id, page_number, line ORDER BY col) AS next FROM boxes b JOIN pages USING (doc_id, page_number))
    SELECT doc_id, page_number, CAST(col * n + n - 1 - line AS INTEGER) AS cell_no, CASE WHEN col = 0 THEN x0 ELSE x0 + 2 END AS x0, y0, CASE WHEN next IS NULL THEN x1 ELSE x1 + 2 END AS x1, y1,
           text || CASE WHEN col = 0 THEN ' s0' ELSE '' END || CASE WHEN next IS NULL THEN '' ELSE ' s' || next END AS text FROM wide
"""
)
def merge_slivers(spark, sf_dir):
    """A sliver goes into the cell on its left, which shares as much of its sides as that on its right; the first into its right one."""
    return _ints(L.merge_small_cells(U.slivers(statement_rows(spark, sf_dir))), *BOX, "cell_no")


@query(
    """
    WITH l AS (SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, 4 + 2 * (o_orderkey % 2) AS length, o_orderkey % 3 AS shift FROM orders)
    SELECT doc_id, 'horizontal' AS orientation, CAST(40 AS INTEGER) AS x0, CAST(unnest([100, 102]) + shift AS INTEGER) AS y0, CAST(40 + length AS INTEGER) AS x1 FROM l
    UNION ALL SELECT doc_id, 'horizontal', 40, CAST(101 + shift AS INTEGER), CAST(40 + length AS INTEGER) FROM l WHERE length > 5
"""
)
def short_lines(spark, sf_dir):
    """Two lines 2 points apart become one in their middle, which goes if it is short; they themselves stay."""
    orders = _table(spark, sf_dir, "orders")
    page = [F.col("o_orderkey").cast("string").alias("doc_id"), F.lit(1).alias("page_number")]
    lines = orders.select(*page, "o_orderkey", F.lit("line").alias("kind"), F.lit(0).cast("long").alias("seq"), F.lit(40.0).alias("x0"), F.explode(F.array(F.lit(100.0), F.lit(102.0))).alias("y"))
    lines = lines.withColumns({"y0": F.col("y") + F.col("o_orderkey") % 3, "x1": (44 + 2 * (F.col("o_orderkey") % 2)).cast("double")}).withColumn("y1", F.col("y0"))
    pages = orders.select(*page, F.lit(612.0).alias("width"), F.lit(792.0).alias("height")).distinct()
    found = L.clean_lines(L.all_lines(lines, lines.limit(0)), pages)
    return _ints(found.select("doc_id", "orientation", "x0", "y0", "x1"), "x0", "y0", "x1")


@query(
    """
    WITH v AS (SELECT l_orderkey AS k, l_quantity * 2 AS y, min(l_partkey * 10 + l_linenumber) AS seen FROM lineitem GROUP BY ALL),
    f AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY seen, y) > 1 AS later FROM v),
    m AS (SELECT *, CASE WHEN abs(y - lag(y) OVER (PARTITION BY k ORDER BY later, y)) <= 3 THEN 0 ELSE 1 END AS new FROM f),
    g AS (SELECT *, sum(new) OVER (PARTITION BY k ORDER BY later, y) AS n FROM m),
    s AS (SELECT k, y, n, avg(y) OVER (PARTITION BY k, n) AS squashed FROM g),
    l AS (SELECT l_orderkey AS k, squashed AS y, l_partkey % 500 AS a, l_partkey % 500 + l_linenumber * 10 AS b, n FROM lineitem JOIN s ON s.k = l_orderkey AND s.y = l_quantity * 2),
    lm AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY k, n ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 3 THEN 0 ELSE 1 END AS new FROM l),
    lg AS (SELECT *, sum(new) OVER (PARTITION BY k, n ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS p FROM lm)
    SELECT k, CAST(min(a) AS DOUBLE) AS x0, round(y, 6) AS y0, CAST(max(b) AS DOUBLE) AS x1 FROM lg GROUP BY k, n, y, p
"""
)
def cluster_lines_first_seen(spark, sf_dir):
    y, x = F.col("l_quantity") * 2, (F.col("l_partkey") % 500).cast("double")
    seen = (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("seq")
    lines = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), x.alias("x0"), y.alias("y0"), (x + F.col("l_linenumber") * 10).alias("x1"), y.alias("y1"), seen)
    return intervals.cluster_lines(lines, "y", keys=["k"], first_seen="seq").select("k", "x0", F.round("y0", 6).alias("y0"), "x1")


#: The plain statements in SQL: cell has their texts, logical those that are one, with their boxes.
PLAIN = """
    WITH o AS (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS n FROM orders
    ), body AS (
        SELECT CAST(o_custkey AS VARCHAR) AS doc_id, CAST(n // 10 + 1 AS INTEGER) AS page_number, CAST(n % 10 + 1 AS INTEGER) AS line, o_orderkey % 4 AS kind,
               CASE o_orderkey % 4 WHEN 1 THEN [o_orderpriority] WHEN 2 THEN ['CR', 'dr']
               ELSE [o_orderpriority, CAST(CAST(o_orderdate AS DATE) AS VARCHAR), CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS VARCHAR)] END AS texts FROM o
    ), r AS (
        SELECT * FROM body UNION ALL SELECT DISTINCT doc_id, page_number, 0, 9, ['Txn Date', 'Ref No', 'Balance', 'Amt'] FROM body
    ), pages AS (
        SELECT doc_id, page_number, max(line) + 1 AS n FROM r GROUP BY ALL
    ), cell AS (
        SELECT r.*, n - 1 - line AS band_no, CAST(c AS INTEGER) AS col, texts[c + 1] AS text, 760 - 20 * line AS base,
               CASE c WHEN 0 THEN 40 WHEN 1 THEN 47 + 5 * length(texts[1]) ELSE 300 END AS x0, CASE WHEN c = 3 THEN 1 WHEN c = 2 AND kind = 9 THEN 10 ELSE 5 END AS up
        FROM r JOIN pages USING (doc_id, page_number), range(4) AS t(c) WHERE c < len(texts) AND CAST(doc_id AS BIGINT) % 7 <> 0
    ), logical AS (
        SELECT doc_id, page_number, line, kind, band_no, least(col, 2) AS part, string_agg(text, ' ' ORDER BY col) AS text, min(x0) AS x0, min(base + up) AS y0, max(x0 + 5 * length(text)) AS x1, max(base + up + 8) AS y1
        FROM cell GROUP BY doc_id, page_number, line, kind, band_no, least(col, 2)
    )
"""
PLACES = "CAST(x0 AS INTEGER) AS x0, CAST(y0 AS INTEGER) AS y0, CAST(x1 AS INTEGER) AS x1, CAST(y1 AS INTEGER) AS y1"


def _plain_words(spark, sf_dir):
    frames = U.unruled(spark, sf_dir)
    return words.words(words.band_chars(frames["chars"], words.bands(frames["segments"])))


@query(
    PLAIN
    + f"""
    , w AS (SELECT *, unnest(string_split(text, ' ')) AS word, unnest(range(len(string_split(text, ' ')))) AS i FROM cell),
    p AS (SELECT doc_id, page_number, CAST(band_no AS INTEGER) AS band_no, col, i, word AS text, x0 + CASE WHEN i = 0 THEN 0 ELSE 5 * (length(string_split(text, ' ')[1]) + 1) END AS x0, base + up AS y0, base + up + 8 AS y1 FROM w),
    q AS (SELECT *, x0 + 5 * length(text) AS x1 FROM p)
    SELECT doc_id, page_number, band_no, CAST(row_number() OVER (PARTITION BY doc_id, page_number, band_no ORDER BY y0 DESC, x0) - 1 AS INTEGER) AS ordinal, text, {PLACES} FROM q
"""
)
def split_words(spark, sf_dir):
    return _ints(_plain_words(spark, sf_dir), *BOX, "band_no", "ordinal")


@query(PLAIN + f"SELECT doc_id, page_number, CAST(band_no AS INTEGER) AS band_no, text, {PLACES} FROM logical")
def merged_words(spark, sf_dir):
    """Words of a text with gaps up to 6 points are one, as are two lines of a text."""
    return _ints(words.logical_cells(_plain_words(spark, sf_dir)).drop("ordinal"), *BOX, "band_no")


@query(
    PLAIN
    + f"""
    , p AS (SELECT doc_id, page_number, CAST(band_no AS INTEGER) AS band_no, CAST(CASE WHEN part = 2 THEN 1 ELSE 0 END AS INTEGER) AS ordinal, string_agg(text, ' ' ORDER BY part) AS text,
            min(x0) AS x0, min(y0) AS y0, arg_max(x1, part) AS x1, max(y1) AS y1 FROM logical GROUP BY doc_id, page_number, band_no, part = 2)
    SELECT doc_id, page_number, band_no, ordinal, text, {PLACES} FROM p
"""
)
def merged_phrases(spark, sf_dir):
    """The first two texts of a line, 7 points apart, are one phrase at a tolerance of 8."""
    return _ints(words.phrases(words.logical_cells(_plain_words(spark, sf_dir)), 8.0), *BOX, "band_no", "ordinal")


@query(
    PLAIN
    + f", kw AS (SELECT * FROM (VALUES {_keyword_sql(headers.KEYWORDS + headers.BLOCK_KEYWORDS)}) AS t(text)), {_grams_sql('a', 'logical')}, {_grams_sql('b', 'kw')}"
    + """
    , pairs AS (SELECT a.text, b.text AS keyword, sum(a.w * b.w) AS s FROM a JOIN b USING (g) GROUP BY ALL),
    best AS (SELECT text, max(s) AS s FROM pairs GROUP BY text),
    scored AS (SELECT doc_id, page_number, line, CASE WHEN any_value(kind) = 2 THEN 0 ELSE avg(coalesce(s, 0)) END AS confidence, string_agg(text, ', ' ORDER BY part) AS phrases
               FROM logical LEFT JOIN best USING (text) GROUP BY doc_id, page_number, line HAVING count(*) >= 2),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY round(confidence, 9) DESC, page_number, line DESC) AS INTEGER) AS rank FROM scored)
    SELECT doc_id, page_number, rank, CAST(760 - 20 * line AS INTEGER) AS lower_y, CAST(780 - 20 * line AS INTEGER) AS upper_y, round(confidence, 6) AS confidence, phrases FROM ranked WHERE rank <= 5
"""
)
def uneven_blocks(spark, sf_dir):
    """Bands of one phrase are no blocks, CR and DR alone score nothing, and pages without edges have none."""
    found = header_blocks(U.unruled(spark, sf_dir))
    texts = F.array_join(F.transform("phrases", lambda p: p["text"]), ", ")
    return _ints(found.select(*P, "rank", "lower_y", "upper_y", F.round("confidence", 6).alias("confidence"), texts.alias("phrases")), "lower_y", "upper_y", "rank")


@query(
    PLAIN
    + """
    , sides AS (SELECT DISTINCT doc_id, page_number, unnest([['edge', CAST(760 - 20 * line AS VARCHAR)], ['line', CAST(780 - 20 * line AS VARCHAR)]]) AS e FROM r WHERE CAST(doc_id AS BIGINT) % 7 <> 0)
    SELECT doc_id, page_number, e[1] AS kind, CAST(e[2] AS INTEGER) AS y, 'horizontal' AS orientation FROM sides
"""
)
def lines_and_edges(spark, sf_dir):
    """Segments of both kinds, each drawn twice; the first stays."""
    segments = U.unruled(spark, sf_dir)["segments"]
    found = C.read_segments(segments.unionByName(segments.withColumn("seq", F.col("seq") + 1000)))
    return found.select(*P, "kind", F.col("y0").cast("int").alias("y"), "orientation")


@query(
    """
    SELECT CAST(user_id AS VARCHAR) AS doc_id, CAST(event_id % 9 AS INTEGER) AS page_number, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS x0,
           CAST(event_id AS DOUBLE) AS y0, value + 1 AS x1, CAST(event_id + 1 AS DOUBLE) AS y1, CAST(NULL AS BIGINT) AS seq FROM events
"""
)
def schema_guard(spark, sf_dir):
    """Types are cast, not-a-number is null, what is optional and missing is null, and other columns go."""
    e = _table(spark, sf_dir, "events")
    x0 = F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    raw = e.select("event_type", F.col("user_id").alias("doc_id"), (F.col("event_id") % 9).alias("page_number"), x0.alias("x0"), F.col("event_id").alias("y0"), (F.col("value") + 1).alias("x1"), (F.col("event_id") + 1).alias("y1"))
    return validate_schema(raw, RECTS)


def word_decoder(doc_id: str, content: bytes):
    """Stands for a decoder of page files: a page for each document, an object for each word; one of fewer than 5 words is broken."""
    found = content.decode().split(" ")
    if (n := len(found) - found.count("")) < 5:
        raise ValueError(f"{n} words")
    yield "pages", {"page_number": 1, "width": 612.0, "height": 792.0}
    for i, word in enumerate(found):
        if word:
            yield "chars", {"page_number": 1, "text": word, "x0": float(i), "y0": 0.0, "x1": i + 1.0, "y1": 1.0}


DECODED = "WITH w AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, string_split(coalesce(text, ''), ' ') AS w FROM documents), o AS (SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS i FROM w)"


def _decoded(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    content = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    return decode(content, word_decoder)


@query(DECODED + "SELECT doc_id, 1 AS page_number, count(*) AS chars, CAST(max(i) AS DOUBLE) AS right_end, CAST(sum(length(t)) AS BIGINT) AS letters FROM o WHERE t <> '' GROUP BY doc_id HAVING count(*) >= 5")
def decoded_documents(spark, sf_dir):
    frames, _ = _decoded(spark, sf_dir)
    found = frames["chars"].groupBy(*P).agg(F.count("*").alias("chars"), F.max("x1").alias("right_end"), F.sum(F.length("text")).alias("letters"))
    return found.join(frames["pages"].select(*P), P)


@query(DECODED + "SELECT doc_id, 'decode' AS stage, count_if(t <> '') || ' words' AS message FROM o GROUP BY doc_id HAVING count_if(t <> '') < 5")
def decode_errors(spark, sf_dir):
    return _decoded(spark, sf_dir)[1]
