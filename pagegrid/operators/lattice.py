"""Cells of pages whose grid is drawn with gaps: cleaned lines, covered spans, linked cells."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagegrid.functions.geometry import bin_edge, extend_line, isclose, orientation_lattice, rect_lines, snap_to_grid, span_cover, strict_link
from pagegrid.operators.cells import cell_text
from pagegrid.operators.graph import page_components
from pagegrid.operators.intervals import cluster_lines, merge_lines, squash
from pagegrid.runtime import dealt
from pagegrid.schema import BOX, P, Config


def _oriented(lines: DataFrame) -> DataFrame:
    return lines.withColumn("orientation", orientation_lattice(F.col("y0"), F.col("y1")))


def all_lines(segments: DataFrame, rects: DataFrame) -> DataFrame:
    """P, box, orientation, seq: lines, edges and the sides of rectangles, without repetitions.

    seq tells which came first: lines and edges by the stream, then rectangles with their sides.
    """
    after = F.lit(1 << 40) + 4 * F.coalesce("seq", F.lit(0))
    sides = rects.select(*P, after.alias("from"), F.posexplode(rect_lines(*map(F.col, BOX))).alias("side", "s")).select(*P, "s.*", (F.col("from") + F.col("side")).alias("seq"))
    return _once(_oriented(segments.select(*P, *BOX, F.col("seq").cast("long").alias("seq")).unionByName(sides)))


def _once(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*P, *BOX, "orientation").agg(F.min("seq").alias("seq"))


def clean_lines(lines: DataFrame, pages: DataFrame, config: Config = Config()) -> DataFrame:
    """Snapped lines, and those merged, squashed and long enough that come of them."""
    snapped = lines.join(pages.select(*P, "width", "height"), P)
    snapped = snapped.select(*P, *(snap_to_grid(F.col(c), F.col("width" if c[0] == "x" else "height")).alias(c) for c in BOX), "orientation", "seq")
    out = snapped.select(*P, *BOX, "seq")
    for axis, along, kind in (("y", "x", "horizontal"), ("x", "y", "vertical")):
        merged = merge_lines(snapped.where(F.col("orientation") == kind), axis, config.tol)
        close = squash(merged, P, f"{axis}0", config.tol).drop("cluster")
        merged = merged.join(close, [*P, f"{axis}0"]).withColumns({f"{axis}0": F.col("squashed"), f"{axis}1": F.col("squashed")})
        out = out.unionByName(merged.where(F.abs(F.col(f"{along}1") - F.col(f"{along}0")) > config.min_length).select(*P, *BOX, F.lit(None).cast("long").alias("seq")))
    return _once(_oriented(out))


def finalise_lines(lines: DataFrame, config: Config = Config()) -> DataFrame:
    """Lines clustered over both axes and made longer at both ends."""
    seen = "seq" if config.first_seen else None
    flat = cluster_lines(lines.where("orientation = 'horizontal'"), "y", config.tol, first_seen=seen)
    up = cluster_lines(lines.where("orientation = 'vertical'"), "x", config.tol, first_seen=seen)
    longer = flat.unionByName(up).select(*P, extend_line(*map(F.col, BOX), by=config.extension).alias("s")).select(*P, "s.*")
    return _oriented(longer).distinct()


def _intervals(lines: DataFrame, axis: str) -> DataFrame:
    values = lines.select(*P, F.col(f"{axis}0").alias("v")).union(lines.select(*P, F.col(f"{axis}1"))).distinct()
    nxt = F.lead("v").over(Window.partitionBy(*P).orderBy("v"))
    return values.withColumn("n", nxt).where("n is not null").select(*P, F.col("v").alias(f"{axis}0"), F.col("n").alias(f"{axis}1"))


def covered_boxes(lines: DataFrame, config: Config = Config()) -> DataFrame:
    """P, box: between neighbouring coordinates, where a line covers each of the four sides.

    Which intervals the lines at a coordinate cover is found first, for each side alone.
    """
    xs, ys = _intervals(lines, "x"), _intervals(lines, "y")
    flat = lines.where("orientation = 'horizontal'").select(*P, F.col("y0").alias("at"), F.least("x0", "x1").alias("a"), F.greatest("x0", "x1").alias("b")).distinct()
    up = lines.where("orientation = 'vertical'").select(*P, F.col("x0").alias("at"), F.least("y0", "y1").alias("a"), F.greatest("y0", "y1").alias("b")).distinct()

    def sides(spans: DataFrame, along: str, axis: str) -> DataFrame:
        """P, interval along, coordinate of the other axis where some line covers it."""
        over = (xs if along == "x" else ys).join(spans, P).where(span_cover(F.col("a"), F.col("b"), F.col(f"{along}0"), F.col(f"{along}1"), config.tol, config.min_overlap_ratio))
        ends = xs if axis == "x" else ys
        coords = ends.select(*P, F.col(f"{axis}0").alias("v")).union(ends.select(*P, F.col(f"{axis}1"))).distinct()
        return over.select(*P, f"{along}0", f"{along}1", "at").distinct().join(coords, P).where(isclose(F.col("at"), F.col("v"), config.tol)).select(*P, f"{along}0", f"{along}1", "v").distinct()

    h, v = sides(flat, "x", "y"), sides(up, "y", "x")
    boxes = xs.join(h.withColumnRenamed("v", "y0"), [*P, "x0", "x1"]).join(ys, [*P, "y0"])
    boxes = boxes.join(h.withColumnRenamed("v", "y1"), [*P, "x0", "x1", "y1"], "left_semi")
    for side in ("x0", "x1"):
        boxes = boxes.join(v.withColumnRenamed("v", side), [*P, "y0", "y1", side], "left_semi")
    return boxes.select(*P, *BOX)


def lattice_cells(lines: DataFrame, chars: DataFrame, config: Config = Config()) -> DataFrame:
    """P, cell_no, box, text; cells count by x0, then y0."""
    found = cell_text(covered_boxes(lines, config), chars, config.tol, lattice=True)
    return found.select(*P, (F.row_number().over(Window.partitionBy(*P).orderBy("x0", "y0")) - 1).alias("cell_no"), *BOX, "text")


#: Edge of a cell, the neighbour's edge in the same bin, the axis along which both must agree.
SIDES = {"left": ("x0", "x1", "y"), "right": ("x1", "x0", "y"), "top": ("y0", "y1", "x"), "bottom": ("y1", "y0", "x")}


def link_cells(cells: DataFrame, tol: float = 3.0) -> DataFrame:
    """P, cell_no, direction, neighbour_no. `top` is across y0, `bottom` across y1.

    Of several neighbours on a side the last in cell order stays. A link made from the
    other cell's side counts as well.
    """
    out = None
    for name, (mine, theirs, axis) in SIDES.items():
        c = cells.select(*P, "cell_no", *BOX, bin_edge(F.col(mine), tol).alias("bin"))
        n = cells.select(*P, F.col("cell_no").alias("neighbour_no"), *(F.col(x).alias(f"n_{x}") for x in BOX), bin_edge(F.col(theirs), tol).alias("bin"))
        agree = strict_link(F.col(f"{axis}0"), F.col(f"{axis}1"), F.col(f"n_{axis}0"), F.col(f"n_{axis}1"), tol)
        pairs = c.join(n, [*P, "bin"]).where(agree).groupBy(*P, "cell_no").agg(F.max("neighbour_no").alias("neighbour_no"))
        found = pairs.select(*P, "cell_no", F.lit(name).alias("direction"), "neighbour_no")
        out = found if out is None else out.unionByName(found)
    return out


#: Cells of the largest page whose merging is remembered.
KNOWN_CELLS = 1000


def merged_boxes(packed: bytes, tol: float) -> tuple[list[int], list[tuple[int, int]], np.ndarray]:
    """Of a page's boxes, four doubles each, in order of cells: numbers of those that stay, which went into which, and the boxes that stay.

    Small cells go into the neighbour with which they share most; repeated until none does.
    Texts have no part in it, so pages with the same boxes take the same answer.
    """
    return _known(packed, tol) if len(packed) <= 32 * KNOWN_CELLS else _settle(packed, tol)


def _settle(packed: bytes, tol: float) -> tuple[list[int], list[tuple[int, int]], np.ndarray]:
    cells = {k: dict(zip(BOX, box)) for k, box in enumerate(np.frombuffer(packed).reshape(-1, 4).tolist())}
    into: list[tuple[int, int]] = []
    links: dict[int, dict[str, int]] = {k: {} for k in cells}
    opposite = {"left": "right", "right": "left", "top": "bottom", "bottom": "top"}

    def binned(v: float) -> float:
        return round(v / tol) * tol

    def connect() -> None:
        by_edge: dict[tuple[str, float], list[int]] = {}
        for k, c in cells.items():
            for edge in ("x0", "x1", "y0", "y1"):
                by_edge.setdefault((edge, binned(c[edge])), []).append(k)
        for k, c in cells.items():
            for side, (mine, theirs, axis) in SIDES.items():
                for n in by_edge.get((theirs, binned(c[mine])), []):
                    o = cells[n]
                    if all(abs(c[f"{axis}{i}"] - o[f"{axis}{i}"]) < tol for i in "01"):
                        links[k][side] = n
                        links[n][opposite[side]] = k

    def shared(a: dict, b: dict) -> float:
        tall = max(0.0, min(a["y1"], b["y1"]) - max(a["y0"], b["y0"]))
        wide = max(0.0, min(a["x1"], b["x1"]) - max(a["x0"], b["x0"]))
        touching = [("x1", "x0", tall), ("x0", "x1", tall), ("y1", "y0", wide), ("y0", "y1", wide)]
        return next((length for p, q, length in touching if abs(a[p] - b[q]) < 1e-6), 0.0)

    def merge() -> bool:
        any_ = False
        for k in [k for k, c in cells.items() if c["x1"] - c["x0"] < tol or c["y1"] - c["y0"] < tol]:
            small = cells[k]
            near = [links[k][s] for s in SIDES if s in links[k]]
            best, most = None, 0.0
            for n in near:
                if (length := shared(small, all_cells[n])) > most:
                    best, most = n, length
            if best is None:
                continue
            grown = all_cells[best]
            for c, f in (("x0", min), ("y0", min), ("x1", max), ("y1", max)):
                grown[c] = f(grown[c], small[c])
            into.append((k, best))
            del cells[k]
            for n in near:
                links[n] = {s: m for s, m in links[n].items() if m != k}
            any_ = True
        return any_

    all_cells = dict(cells)
    connect()
    while merge():
        connect()
    return list(cells), into, np.array([[c[n] for n in BOX] for c in cells.values()]).reshape(-1, 4)


_known = lru_cache(128)(_settle)


def merged_texts(texts: list[str], kept: list[int], into: list[tuple[int, int]]) -> list[str]:
    """Texts of the cells that stay, with those of the ones that went into them behind."""
    texts = list(texts)
    for k, best in into:
        texts[best] = " ".join(t for t in (texts[best], texts[k]) if t)
    return [texts[k] for k in kept]


def _merge_page(df, tol: float):
    import pandas as pd

    df = df.sort_values("cell_no")
    kept, into, boxes = merged_boxes(df[BOX].to_numpy(np.float64).tobytes(), tol)
    rows = [(df.doc_id.iloc[0], df.page_number.iloc[0], i, *box, text) for i, (box, text) in enumerate(zip(boxes.tolist(), merged_texts(df.text.tolist(), kept, into)))]
    return pd.DataFrame(rows, columns=["doc_id", "page_number", "cell_no", "x0", "y0", "x1", "y1", "text"])


def merge_small_cells(cells: DataFrame, tol: float = 3.0) -> DataFrame:
    """Cells after the small ones have been merged; a page's result depends on its order, so a page goes to Python."""
    schema = "doc_id string, page_number int, cell_no int, x0 double, y0 double, x1 double, y1 double, text string"
    return dealt(cells.select(*P, "cell_no", *BOX, "text"), *P).groupBy(*P).applyInPandas(lambda df: _merge_page(df, tol), schema)


def connected_groups(cells: DataFrame, links: DataFrame, directions: list[str], order: list[Column], least: int = 1) -> DataFrame:
    """P, group_no, box, length, texts of cells connected in some directions; texts without empty ones.

    A link connects both its cells, whichever side it was found from. Following links one
    way only, from the first cell on, gives other groups where a cell is the last neighbour
    of two others: the first of these has lost it then, and here it has not.
    """
    edges = links.where(F.col("direction").isin(directions)).select(*P, F.col("cell_no").alias("a"), F.col("neighbour_no").alias("b"))
    found = page_components(cells.select(*P, "cell_no", *BOX, "text"), edges, P, "cell_no")
    texts = F.filter(F.transform(F.array_sort(F.collect_list(F.struct("cell_no", "text"))), lambda x: x["text"]), lambda t: t != "")
    boxed = found.groupBy(*P, "component").agg(
        F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.count("*").cast("int").alias("length"), texts.alias("texts")
    )
    number = F.row_number().over(Window.partitionBy(*P).orderBy(*order, "component")) - 1
    return boxed.where(F.col("length") >= least).select(*P, number.alias("group_no"), *BOX, "length", "texts")


def rows(cells: DataFrame, links: DataFrame) -> DataFrame:
    return connected_groups(cells, links, ["left", "right"], [F.col("x0")])


def columns(cells: DataFrame, links: DataFrame) -> DataFrame:
    return connected_groups(cells, links, ["top", "bottom"], [F.col("y0")])


def grids(cells: DataFrame, links: DataFrame) -> DataFrame:
    """All that is connected in any direction; stray cells are none."""
    return connected_groups(cells, links, list(SIDES), [F.col("component")], least=2)
