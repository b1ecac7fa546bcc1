"""Cells of ruled pages: intersections, rectangles, the smallest of them, and their text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagegrid.functions.geometry import isclose, orientation, raster, strip
from pagegrid.operators.graph import cluster_means, whole_pages
from pagegrid.operators.packed import whole_documents
from pagegrid.schema import BOX, P


#: Height in points of the strips by which the objects of a page meet.
STRIP = 16.0
#: Pairs of a page's objects that are compared at once.
PAIRS = 1 << 20
#: What geometry.strip takes away.
SPACES = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0"


def strip_of(v: Column) -> Column:
    """Number of the strip that a height is in; far outside of any page all heights are in one."""
    return F.least(F.greatest(F.floor(v / STRIP), F.lit(-64)), F.lit(2048)).cast("int")


def strips(low: Column, high: Column) -> Column:
    """The strips from one height to another, as an array."""
    return F.sequence(strip_of(F.least(low, high)), strip_of(F.greatest(low, high)))


def read_objects(df: DataFrame, columns: list[str]) -> DataFrame:
    """Without exact repetitions; of these the one that comes first in the stream (seq) stays."""
    return df.groupBy(*P, *columns).agg(F.min("seq").alias("seq"))


def read_segments(df: DataFrame) -> DataFrame:
    return read_objects(df.withColumn("orientation", orientation(*map(F.col, BOX))), ["kind", *BOX, "orientation"])


def _snapped(v: np.ndarray, dim: np.ndarray) -> np.ndarray:
    """What geometry.snap_to_grid does, on arrays."""
    last = np.floor(dim) - 1
    return np.where((v < 0) | (last < 0), v, np.minimum(np.floor(v), last))


def _once(table: pa.Table, columns: list[str]) -> pa.Table:
    """Without exact repetitions; the least seq stays."""
    table = table.group_by(columns, use_threads=False).aggregate([("seq", "min")])
    return table.rename_columns([c.replace("seq_min", "seq") for c in table.column_names])


def _cleaned(table: pa.Table, size: np.ndarray, columns: list[str], tol: float) -> pa.Table:
    """What clean_coords does, on rows of pages that `_page` numbers; size: their widths and heights, nan for a page that goes."""
    table = table.take(pa.array(np.flatnonzero(~np.isnan(size[0])[table.column("_page").to_numpy()])))
    table = _once(table, ["_page", *columns])
    page = table.column("_page").to_numpy()
    for x, y in (("x0", "y0"), ("x1", "y1")):
        means = cluster_means(page, table.column(x).to_numpy(), table.column(y).to_numpy(), tol)
        for i, (c, v) in enumerate(zip((x, y), means)):
            table = table.set_column(table.column_names.index(c), c, pa.array(_snapped(v, size[i][page])))
    return _once(table, ["_page", *columns])


def clean_coords(df: DataFrame, pages: DataFrame, columns: list[str], tol: float = 3.0) -> DataFrame:
    """Move both corners to the centroid of their cluster, down to the grid, and drop what is then repeated.

    Rows that repeat before count once. Rows of pages that `pages` does not have go. A page's
    size comes along as a row of its own, so that one shuffle brings all of a page together.
    """
    rows = df.where(" and ".join(f"{c} is not null" for c in BOX)).select(*P, "seq", *columns, F.lit(None).cast("double").alias("width"), F.lit(None).cast("double").alias("height"))
    sizes = pages.select(*P, *(F.lit(None).cast(df.schema[c].dataType).alias(c) for c in ("seq", *columns)), "width", "height")
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in (*P, *columns, "seq"))

    def settle(table: pa.Table, page: np.ndarray) -> pa.Table:
        width, height = (table.column(c).to_numpy() for c in ("width", "height"))
        of, size = ~np.isnan(width), np.full((2, page[-1] + 1), np.nan)
        size[:, page[of]] = width[of], height[of]
        table = table.append_column("_page", pa.array(page)).take(pa.array(np.flatnonzero(~of)))
        return _cleaned(table, size, [*P, *columns], tol).select([*P, *columns, "seq"])

    return whole_pages(rows.unionByName(sizes), P, settle, schema)


def intersections(segments: DataFrame, keys: list[str] = P) -> DataFrame:
    """keys, x, y: where a vertical meets a horizontal; only a line's first fixed coordinate counts."""
    h = segments.where("orientation = 'horizontal'").select(*keys, F.col("x0").alias("h0"), F.col("x1").alias("h1"), F.col("y0").alias("y")).distinct()
    v = segments.where("orientation = 'vertical'").select(*keys, F.col("y0").alias("v0"), F.col("y1").alias("v1"), F.col("x0").alias("x")).distinct()
    meet = F.col("x").between(F.col("h0"), F.col("h1")) & F.col("y").between(F.col("v0"), F.col("v1"))
    h, v = h.withColumn("_strip", strip_of(F.col("y"))), v.withColumn("_strip", F.explode(strips(F.col("v0"), F.col("v1"))))
    return h.join(v, [*keys, "_strip"]).where(meet).select(*keys, "x", "y").distinct()


def _pairs(points: DataFrame, keys: list[str]) -> DataFrame:
    """keys, x1, x2, y: two points of the same height."""
    a, b = points.select(*keys, F.col("x").alias("x1"), "y"), points.select(*keys, F.col("x").alias("x2"), "y")
    return a.join(b, [*keys, "y"]).where("x1 < x2")


def rectangles(points: DataFrame, keys: list[str] = P) -> DataFrame:
    """keys, x1, y1, x2, y2: all rectangles whose corners are points; sides need not be drawn."""
    pairs = _pairs(points, keys)
    low, high = pairs.withColumnRenamed("y", "y1"), pairs.withColumnRenamed("y", "y2")
    return low.join(high, [*keys, "x1", "x2"]).where("y1 < y2").select(*keys, "x1", "y1", "x2", "y2")


def _least(rects: DataFrame, keys: list[str], sides: tuple = ("y2", "x2", "y1", "x1")) -> DataFrame:
    """Of the rectangles that have three sides in common only the least; each of the others contains it."""
    for side in sides:
        best = F.min if side in ("x2", "y2") else F.max
        over = Window.partitionBy(*keys, *(c for c in ("x1", "y1", "x2", "y2") if c != side))
        rects = rects.withColumn("_best", best(side).over(over)).where(F.col(side) == F.col("_best")).drop("_best")
    return rects


def _innermost(rects: DataFrame, keys: list[str]) -> DataFrame:
    """Rectangles that contain no other; they meet in the strips that the outer one reaches."""
    box = ["x1", "y1", "x2", "y2"]
    o = rects.withColumn("_strip", F.explode(strips(F.col("y1"), F.col("y2")))).alias("o")
    i = rects.withColumn("_strip", strip_of(F.col("y1"))).alias("i")
    same = [F.col(f"o.{k}") == F.col(f"i.{k}") for k in (*keys, "_strip")]
    inside = (F.col("o.x1") <= F.col("i.x1")) & (F.col("o.y1") <= F.col("i.y1")) & (F.col("o.x2") >= F.col("i.x2")) & (F.col("o.y2") >= F.col("i.y2"))
    other = F.greatest(*(F.col(f"o.{c}") != F.col(f"i.{c}") for c in box))
    outer = o.join(i, [*same, inside, other], "left_semi").select(*keys, *box)
    return rects.join(outer, [*keys, *box], "left_anti")


def level0(rects: DataFrame, keys: list[str] = P) -> DataFrame:
    """Rectangles that contain no other.

    Only those least in each direction, given their other three sides, can be; the rest
    contain one of these. What is left is compared strip by strip.
    """
    return _innermost(_least(rects.distinct(), keys), keys)


def cell_boxes(points: DataFrame, keys: list[str] = P) -> DataFrame:
    """level0 of all rectangles of the points, without building them all.

    Over two points of the same height only the next two at the same x are taken: any
    higher two make a rectangle that contains this one.
    """
    nearest = F.lead("y").over(Window.partitionBy(*keys, "x1", "x2").orderBy("y"))
    rects = _pairs(points.distinct(), keys).withColumn("y2", nearest).where("y2 is not null").select(*keys, "x1", F.col("y").alias("y1"), "x2", "y2")
    return _innermost(_least(rects, keys, ("x2", "x1")), keys)


def empty_rectangles(rects: DataFrame, points: DataFrame, keys: list[str] = P) -> DataFrame:
    """Rectangles without an intersection strictly inside."""
    r, p = rects.alias("r"), points.alias("p")
    inside = (F.col("p.x") > F.col("r.x1")) & (F.col("p.x") < F.col("r.x2")) & (F.col("p.y") > F.col("r.y1")) & (F.col("p.y") < F.col("r.y2"))
    return r.join(p, [*(F.col(f"r.{k}") == F.col(f"p.{k}") for k in keys), inside], "left_anti")


def _levels_by_pairs(box: np.ndarray) -> np.ndarray:
    """Each rectangle against all smaller ones."""
    level = np.zeros(len(box), np.int32)
    order = np.argsort((box[:, 2] - box[:, 0]) * (box[:, 3] - box[:, 1]), kind="stable")
    x1, y1, x2, y2 = np.ascontiguousarray(box[order].T)
    done = np.zeros(len(box), np.int32)
    for n in range(len(box)):
        held = (x1[:n] >= x1[n]) & (y1[:n] >= y1[n]) & (x2[:n] <= x2[n]) & (y2[:n] <= y2[n])
        done[n] = np.max(done[:n], initial=-1, where=held) + 1
    level[order] = done
    return level


def _levels_by_grid(at: np.ndarray, wide: int, high: int) -> np.ndarray:
    """at: places of each rectangle's sides among the page's coordinates (x1, y1, x2, y2).

    `most[h]` has the longest chain inside each stretch of w by h steps: that of the four
    stretches one step shorter, and one more where a rectangle fills it.
    """
    level = np.zeros(len(at), np.int32)
    w, h = at[:, 2] - at[:, 0], at[:, 3] - at[:, 1]
    order = np.lexsort((h, w))
    cuts = np.searchsorted((w * (high + 1) + h)[order], np.arange((wide + 1) * (high + 1) + 1))
    most = [np.zeros((wide, high - k), np.int32) for k in range(high)]
    for i in range(1, wide):
        row = [np.zeros((wide - i, high), np.int32)]
        for k in range(1, high):
            best = np.maximum(np.maximum(most[k][:-1], most[k][1:]), np.maximum(row[-1][:, :-1], row[-1][:, 1:]))
            here = order[cuts[i * (high + 1) + k] : cuts[i * (high + 1) + k + 1]]
            if len(here):
                x, y = at[here, 0], at[here, 1]
                level[here] = best[x, y]
                best[x, y] += 1
            row.append(best)
        most = row
    return level


def _levels(box: np.ndarray) -> np.ndarray:
    """Levels of one page's distinct rectangles (x1, y1, x2, y2): over their pairs, or over all stretches of a grid if these are fewer."""
    xs, x = np.unique(box[:, [0, 2]], return_inverse=True)
    ys, y = np.unique(box[:, [1, 3]], return_inverse=True)
    if (len(xs) * len(ys)) ** 2 // 4 > len(box) ** 2 // 2:
        return _levels_by_pairs(box)
    x, y = x.reshape(-1, 2), y.reshape(-1, 2)
    return _levels_by_grid(np.stack([x[:, 0], y[:, 0], x[:, 1], y[:, 1]], 1), len(xs), len(ys))


def levels(rects: DataFrame) -> DataFrame:
    """All rectangles with their level: 0 if they contain none, else one more than the highest contained.

    A page's chain needs its rectangles in order of area, so whole pages go to Python.
    """

    def work(table: pa.Table, page: np.ndarray) -> pa.Table:
        box = np.stack([table.column(c).to_numpy() for c in ("x1", "y1", "x2", "y2")], 1)
        cuts = np.flatnonzero(np.diff(page)) + 1
        level = np.concatenate([_levels(x) for x in np.split(box, cuts)])
        return table.append_column("level", pa.array(level))

    schema = "doc_id string, page_number int, x1 double, y1 double, x2 double, y2 double, level int"
    return whole_pages(rects.select(*P, "x1", "y1", "x2", "y2").distinct(), P, work, schema)


def joined_text(order: Column, text: Column, separator: str = "") -> Column:
    """Aggregate: texts in the order of a struct, so that no shuffle changes it."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), text.alias("t")))), lambda x: x["t"]), separator)


def cell_text(boxes: DataFrame, chars: DataFrame, tol: float = 3.0, lattice: bool = False) -> DataFrame:
    """Boxes (P, x0, y0, x1, y1) with the text of the chars inside, by tol; '' without any.

    Text follows the stream, or for the lattice goes from top left to bottom right and is
    stripped. A char may be in several cells. Chars and boxes meet strip by strip: a box in
    all that it reaches by tol, a char in that of its lower edge (one that is upside down, in
    all between its edges, and only the first that both have counts).
    """
    b = boxes.select(*P, *BOX).distinct()
    c = chars.select(*P, "text", "seq", *(F.col(n).alias(f"c_{n}") for n in BOX))
    c = c.withColumn("c_first", strip_of(F.least("c_y0", "c_y1"))).withColumn("_strip", F.explode(F.sequence("c_first", strip_of(F.col("c_y0")))))
    reach = strips(F.col("y0") - tol, F.col("y1") + tol)
    strip_b = b.withColumn("first", F.array_min(reach)).withColumn("_strip", F.explode(reach))
    inside = (F.col("c_x0") >= F.col("x0") - tol) & (F.col("c_x1") <= F.col("x1") + tol) & (F.col("c_y0") >= F.col("y0") - tol) & (F.col("c_y1") <= F.col("y1") + tol)
    order = F.struct(-F.col("c_y0"), F.col("c_x0"), F.col("seq")) if lattice else F.struct("seq")
    once = F.col("_strip") == F.greatest("first", "c_first")
    held = strip_b.join(c, [*P, "_strip"]).where(inside & once).select(*P, *BOX, F.struct(order.alias("o"), F.col("text").alias("t")).alias("held"))
    empty = b.select(*P, *BOX, F.lit(None).cast(held.schema["held"].dataType).alias("held"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list("held")), lambda x: x["t"]), "")
    return held.unionByName(empty).groupBy(*P, *BOX).agg((strip(text) if lattice else text).alias("text"))


def _sorted(*columns: np.ndarray) -> np.ndarray:
    """Distinct rows in order, a row of the result for each column."""
    rows = np.stack(columns)[:, np.lexsort(columns[::-1])]
    return rows[:, np.concatenate([[True], (rows[:, 1:] != rows[:, :-1]).any(0)])] if rows.shape[1] else rows


def _starts(rows: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before it."""
    return np.concatenate([[True], (rows[:, 1:] != rows[:, :-1]).any(0)]) if rows.shape[1] else np.zeros(0, bool)


def _between(page: np.ndarray, at: np.ndarray, of: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) in blocks: j of the page `of[i]` and at[j] from low[i] to high[i]; page and at are in order."""
    known = np.unique(at)
    place = page * (len(known) + 1) + np.searchsorted(known, at)
    first = np.searchsorted(place, of * (len(known) + 1) + np.searchsorted(known, low))
    n = np.maximum(np.searchsorted(place, of * (len(known) + 1) + np.searchsorted(known, high, "right")) - first, 0)
    done, ends = 0, np.cumsum(n)
    while done < len(n):
        to = max(int(np.searchsorted(ends, (ends[done - 1] if done else 0) + PAIRS, "right")), done + 1)
        i = np.repeat(np.arange(done, to), n[done:to])
        yield i, np.arange(len(i)) - np.repeat(np.cumsum(n[done:to]) - n[done:to], n[done:to]) + first[i]
        done = to


def _joined(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.concatenate([x[k] for x in found] or [np.zeros(0, np.int64)]) for k in (0, 1))


def _page_points(table: pa.Table) -> np.ndarray:
    """intersections on rows of pages: page, y, x in order."""
    kind = table.column("orientation").combine_chunks()
    page, *box = (table.column(c).to_numpy() for c in ("_page", *BOX))
    flat, up = (pc.fill_null(pc.equal(kind, k), False).to_numpy(zero_copy_only=False) for k in ("horizontal", "vertical"))
    h = _sorted(*(v[flat] for v in (page, box[1], box[0], box[2])))
    v = _sorted(*(v[up] for v in (page, box[0], box[1], box[3])))
    found = []
    for i, j in _between(h[0].astype(np.int64), h[1], v[0].astype(np.int64), v[2], v[3]):
        meet = (v[1][i] >= h[2][j]) & (v[1][i] <= h[3][j])
        found.append((i[meet], j[meet]))
    i, j = _joined(found)
    return _sorted(v[0][i], h[1][j], v[1][i])


def _page_boxes(points: np.ndarray) -> np.ndarray:
    """cell_boxes on points of pages: page, y1, x1, x2, y2."""
    row = np.cumsum(_starts(points[:2])) - 1
    n = np.searchsorted(row, row, "right") - np.arange(len(row)) - 1
    i = np.repeat(np.arange(len(row)), n)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
    pairs = _sorted(points[0][i], points[2][i], points[2][j], points[1][i])
    page, x1, x2, y1, y2 = np.vstack([pairs[:, :-1], pairs[3:, 1:]])[:, ~_starts(pairs[:3])[1:]]
    rows = _sorted(page, x1, y1, y2, x2)
    page, x1, y1, y2, x2 = rows[:, _starts(rows[:4])]
    rows = _sorted(page, y1, x2, y2, -x1)
    page, y1, x2, y2, x1 = rows[:, _starts(rows[:4])]
    x1 = -x1
    order = np.lexsort((y1, page))
    page, x1, y1, x2, y2 = (c[order] for c in (page, x1, y1, x2, y2))
    outer = np.zeros(len(page), bool)
    for o, i in _between(page.astype(np.int64), y1, page.astype(np.int64), y1, y2):
        outer[o[(i != o) & (x1[o] <= x1[i]) & (x2[o] >= x2[i]) & (y2[o] >= y2[i])]] = True
    return np.stack([page, x1, y1, x2, y2])[:, ~outer]


def page_texts(boxes: np.ndarray, table: pa.Table, tol: float, lattice: bool = False) -> pa.Array:
    """cell_text on boxes and chars of pages: the text of each box."""
    table = table.filter(pc.is_valid(table.column("text")))
    page, x0, y0, x1, y1 = (table.column(c).to_numpy() for c in ("_page", *BOX))
    text = table.column("text").combine_chunks()
    seq = pc.fill_null(table.column("seq"), np.iinfo(np.int64).min).to_numpy()
    codes = text.dictionary_encode()
    rank = np.empty(len(codes.dictionary), np.int64)
    rank[pc.sort_indices(codes.dictionary).to_numpy()] = np.arange(len(rank))
    rank = rank[codes.indices.to_numpy()]
    of, left, low, right, high = boxes
    found = []
    for over in (False, True):  # a char that is upside down may begin over the box
        mine = np.flatnonzero((y0 > y1) == over)
        mine = mine[np.lexsort((y0[mine], page[mine]))]
        top = np.full(len(of), np.inf) if over else high + tol
        for i, j in _between(page[mine], y0[mine], of.astype(np.int64), low - tol, top):
            j = mine[j]
            inside = (x0[j] >= left[i] - tol) & (x1[j] <= right[i] + tol) & (y1[j] <= high[i] + tol)
            found.append((i[inside], j[inside]))
    i, j = _joined(found)
    order = np.lexsort((rank[j], seq[j], x0[j], -y0[j], i) if lattice else (rank[j], seq[j], i))
    ends = np.searchsorted(i[order], np.arange(len(of) + 1)).astype(np.int32)
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), text.take(pa.array(j[order]))), "")
    return pc.utf8_trim(joined, SPACES) if lattice else joined


def cells(pages: DataFrame, chars: DataFrame, segments: DataFrame, tol: float = 3.0, clean_chars: bool = True) -> DataFrame:
    """P, cell_no, x0, y0, x1, y1, width, height, text, ordinal of ruled pages; cells count by x0, then from the top, and over the document as in document_order.

    This is clean_coords, intersections, cell_boxes and cell_text, page by page: a page's
    objects are shuffled once, packed.
    """
    segments = segments.withColumn("orientation", orientation(*map(F.col, BOX)))
    box, seq = [F.col(c).cast("double").alias(c) for c in BOX], F.col("seq").cast("long").alias("seq")
    sizes = pages.where("width is not null and height is not null").select(*P, *(F.col(c).cast("double").alias(c) for c in ("width", "height")))

    def work(tables: list[pa.Table], n: int) -> dict[str, np.ndarray | pa.Array]:
        size = np.full((2, n), np.nan)
        size[:, tables[0].column("_page").to_numpy()] = [tables[0].column(c).to_numpy() for c in ("width", "height")]
        boxes = _page_boxes(_page_points(_cleaned(tables[2], size, ["kind", *BOX, "orientation"], tol)))
        chars = _cleaned(tables[1], size, ["text", *BOX], tol) if clean_chars else _once(tables[1], ["_page", "text", *BOX])
        page, x0, y0, x1, y1 = boxes
        number, ordinal = np.empty((2, len(page)), np.int64)
        first = np.searchsorted(np.sort(page), page)
        for out, order in ((number, (y1, x1, -y0, x0, page)), (ordinal, (y1, x1, x0, -y0, page))):
            out[np.lexsort(order)] = np.arange(len(page))
            out -= first
        got = dict(zip(BOX, (x0, y0, x1, y1))) | {"width": np.abs(x1 - x0), "height": np.abs(y1 - y0)}
        return got | {"page": page.astype(np.int64), "cell_no": number.astype(np.int32), "text": page_texts(boxes, chars, tol), "ordinal": ordinal}

    schema = "doc_id string, page_number int, cell_no int, x0 double, y0 double, x1 double, y1 double, width double, height double, text string, ordinal int"
    frames = [sizes, chars.select(*P, "text", *box, seq), segments.select(*P, "kind", *box, "orientation", seq)]
    return whole_documents(frames, work, schema)


def rect_cells(rects: DataFrame, chars: DataFrame, tol: float = 3.0) -> DataFrame:
    """Each drawn rectangle as a cell of its own."""
    return cell_text(rects.select(*P, *BOX), chars, tol, lattice=True)


def corner_cells(segments: DataFrame) -> DataFrame:
    """Cells between neighbouring edges with equal corners (exploratory)."""
    flat = segments.where("orientation = 'horizontal'").select(*P, *BOX).distinct()
    up = segments.where("orientation = 'vertical'").select(*P, *BOX).distinct()
    over_h = Window.partitionBy(*P, "x0", "x1").orderBy("y0")
    over_v = Window.partitionBy(*P, "y0", "y1").orderBy("x0")
    h = flat.withColumn("next", F.lead("y0").over(over_h)).where("next is not null").select(*P, "x0", "x1", F.col("y0"), F.col("next").alias("y1"))
    v = up.withColumn("next", F.lead("x0").over(over_v)).where("next is not null").select(*P, "x0", F.col("next").alias("x1"), "y0", "y1")
    return h.join(v, [*P, *BOX], "left_semi")


def raster_corners(boxes: DataFrame, pages: DataFrame) -> DataFrame:
    """Row and column of both corners in a bitmap of the page."""
    at = [raster(F.col(f"x{i}"), F.col(f"y{i}"), F.col("width"), F.col("height")).alias(f"corner{i}") for i in (0, 1)]
    return boxes.select(*P, *BOX).join(pages.select(*P, "width", "height"), P).select(*P, *BOX, *at)


def groups(found: DataFrame, kind: str = "row", tol: float = 1.0) -> DataFrame:
    """Rows (or columns) of adjacent cells: P, group_no, box, length, cells, texts.

    Cells go by the fixed coordinate, then along it; a group ends where the fixed
    coordinate changes by tol or more, or where a cell does not begin where the last ended.
    Rows count from the top, columns from the left.
    """
    if kind not in ("row", "column"):
        raise ValueError("kind must be 'row' or 'column'")
    fixed, along, end = ("y0", "x0", "x1") if kind == "row" else ("x0", "y0", "y1")
    over = Window.partitionBy(*P).orderBy(fixed, along, "cell_no")
    last = F.lag(F.struct(fixed, end)).over(over)
    same = (F.abs(F.col(fixed) - last[fixed]) < tol) & isclose(last[end], F.col(along), 1.0)
    marked = found.withColumn("_new", last.isNull() | ~same)
    marked = marked.withColumn("_g", F.sum(F.when(F.col("_new"), 1).otherwise(0)).over(over.rowsBetween(Window.unboundedPreceding, 0)))
    cell = F.struct(F.col(along).alias("o"), F.col("cell_no").alias("n"), F.struct(*BOX, "text").alias("c"))
    got = marked.groupBy(*P, "_g").agg(
        F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"),
        F.count("*").cast("int").alias("length"), F.transform(F.array_sort(F.collect_list(cell)), lambda x: x["c"]).alias("cells"),
    )
    order = [F.desc("y0"), "x0", "_g"] if kind == "row" else ["x0", "y0", "_g"]
    number = F.row_number().over(Window.partitionBy(*P).orderBy(*order)) - 1
    return got.select(*P, number.alias("group_no"), *BOX, "length", "cells", F.transform("cells", lambda x: x["text"]).alias("texts"))


def document_order(found: DataFrame, kind: str = "cell") -> DataFrame:
    """With an ordinal over the document: cells by page, from the top, by x0; rows from the top; columns by x0."""
    order = {"cell": [F.desc("y0"), "x0"], "row": [F.desc("y0"), "x0"], "column": ["x0", "y0"]}[kind]
    return found.withColumn("ordinal", F.row_number().over(Window.partitionBy("doc_id").orderBy("page_number", *order, "x1", "y1")) - 1)
