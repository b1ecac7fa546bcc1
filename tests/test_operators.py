"""Operators on hand-made pages."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagegrid.functions import geometry as G
from pagegrid.operators import cells as C
from pagegrid.operators import intervals
from pagegrid.operators.graph import connected_components, epsilon_clusters
from pagegrid.operators.lattice import merge_small_cells
from pagegrid.operators.packed import packed, unpacked
from pagegrid.schema import CHARS, RECTS, split_nulls, validate_schema

KEY = "doc_id string, page_number int"


def grid(spark, xs, ys):
    rows = [("d", 1, "horizontal", xs[0], y, xs[-1], y) for y in ys] + [("d", 1, "vertical", x, ys[0], x, ys[-1]) for x in xs]
    return spark.createDataFrame([(a, b, c, *map(float, d)) for a, b, c, *d in rows], f"{KEY}, orientation string, x0 double, y0 double, x1 double, y1 double")


def test_grid_of_two_by_two(spark):
    points = C.intersections(grid(spark, [0, 10, 30], [0, 5, 9]))
    rects = C.rectangles(points)
    assert (points.count(), rects.count(), C.level0(rects).count()) == (9, 9, 4)
    assert sorted(r.level for r in C.levels(rects).collect()) == [0] * 4 + [1] * 4 + [2]
    assert C.empty_rectangles(rects, points).count() == 8


def test_aligned_grids_make_a_phantom_cell(spark):
    two = grid(spark, [0, 10], [0, 5]).unionByName(grid(spark, [0, 10], [20, 25]))
    boxes = {(r.y1, r.y2) for r in C.level0(C.rectangles(C.intersections(two))).collect()}
    assert boxes == {(0, 5), (5, 20), (20, 25)}


def test_level0_is_brute_force(spark):
    rng = random.Random(1)
    points = {(rng.randrange(5), rng.randrange(5)) for _ in range(17)}
    rects = {(a, b, c, d) for a, b in points for c, d in points if a < c and b < d and (a, d) in points and (c, b) in points}
    least = {r for r in rects if not any(r != s and s[0] >= r[0] and s[1] >= r[1] and s[2] <= r[2] and s[3] <= r[3] for s in rects)}
    df = spark.createDataFrame([("d", 1, float(x), float(y)) for x, y in points], f"{KEY}, x double, y double")
    assert {tuple(map(int, r[2:])) for r in C.level0(C.rectangles(df)).collect()} == least


def test_intervals(spark):
    df = spark.createDataFrame([("a", 0.0, 2.0), ("a", 5.0, 8.0), ("b", 0.0, 2.0), ("b", 5.1, 8.0)], "k string, a double, b double")
    got = sorted(map(tuple, intervals.merge_intervals(df, ["k"], "a", "b").collect()))
    assert got == [("a", 0.0, 8.0), ("b", 0.0, 2.0), ("b", 5.1, 8.0)]


def test_squash_by_order_and_by_first_seen(spark):
    df = spark.createDataFrame([("a", float(v), i) for i, v in enumerate([10, 1, 2, 11])], "k string, v double, i int")
    groups = lambda d: sorted(sorted(r.v for r in d.collect() if r.cluster == c) for c in {r.cluster for r in d.collect()})
    assert groups(intervals.squash(df, ["k"], "v")) == [[1, 2], [10, 11]]
    assert groups(intervals.squash(df, ["k"], "v", first_seen="i")) == [[1, 2], [10], [11]]


def test_scalars(spark):
    df = spark.createDataFrame([(1.5,), (4.5,), (7.5,), (-0.5,), (3.9,), (900.0,)], "v double")
    assert [r[0] for r in df.select(G.bin_edge(F.col("v"))).collect()][:3] == [0, 6, 6]
    assert [r[0] for r in df.select(G.snap_to_grid(F.col("v"), F.lit(612.4))).collect()][3:] == [-0.5, 3, 611]
    assert spark.sql("select '  a b\\t' as t").select(G.strip(F.col("t"))).first()[0] == "a b"


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100, i) for i in range(101, 160)] + [(i, i + 1) for i in range(200, 230)]
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.component for r in connected_components(spark.createDataFrame([*edges, (None, 1), (3, 3)], "a int, b int")).collect()}
    assert all(got.get(x, x) == c for x, c in label.items())
    assert connected_components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_epsilon_clusters(spark):
    rng = random.Random(3)
    points = {(rng.uniform(0, 40), rng.uniform(0, 40)) for _ in range(120)}
    df = spark.createDataFrame([("d", *p) for p in points] + [("d", None, 1.0)], "k string, x double, y double")
    label = {p: p for p in points}
    for _ in range(40):
        for a in points:
            for b in points:
                if (a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2 <= 9:
                    label[a] = label[b] = min(label[a], label[b])
    assert {(r.x, r.y): (r.component_x, r.component_y) for r in epsilon_clusters(df, ["k"]).collect()} == label


def test_cell_text_keeps_or_strips_spaces(spark):
    box = spark.createDataFrame([("d", 1, 0.0, 0.0, 50.0, 20.0), ("d", 1, 50.0, 0.0, 90.0, 20.0)], f"{KEY}, x0 double, y0 double, x1 double, y1 double")
    chars = spark.createDataFrame([("d", 1, 0, " ", 1.0, 2.0, 6.0, 12.0), ("d", 1, 1, "1", 6.0, 2.0, 11.0, 12.0)], f"{KEY}, seq long, text string, x0 double, y0 double, x1 double, y1 double")
    assert sorted(r.text for r in C.cell_text(box, chars).collect()) == ["", " 1"]
    assert sorted(r.text for r in C.cell_text(box, chars, lattice=True).collect()) == ["", "1"]


def test_small_cells_merge(spark):
    rows = [("d", 1, 0, 0.0, 0.0, 2.0, 20.0, "a"), ("d", 1, 1, 2.0, 0.0, 40.0, 20.0, "b")]
    df = spark.createDataFrame(rows, f"{KEY}, cell_no int, x0 double, y0 double, x1 double, y1 double, text string")
    assert [tuple(r)[3:] for r in merge_small_cells(df).collect()] == [(0.0, 0.0, 40.0, 20.0, "b a")]


def test_schema(spark):
    df = spark.createDataFrame([("d", 1, float("nan"), 0.0, 1.0, 1.0, "x")], f"{KEY}, x0 double, y0 double, x1 double, y1 double, other string")
    whole, errors = split_nulls(validate_schema(df, RECTS), "rects")
    assert whole.count() == 0 and errors.first().message == "1 objects without coordinates"
    with pytest.raises(ValueError):
        validate_schema(df, CHARS)


def test_config_offers_no_setting_that_nothing_reads():
    import dataclasses
    from pathlib import Path

    from pagegrid.schema import Config

    code = "".join(p.read_text() for p in (Path(__file__).parent.parent / "pagegrid").rglob("*.py"))
    assert [f.name for f in dataclasses.fields(Config) if f"config.{f.name}" not in code] == []


def small_pages(rng):
    """Random cells of a page, some of them slivers, on a grid that is not quite even."""
    xs = sorted({round(rng.uniform(0, 60), rng.choice([0, 1])) for _ in range(6)})
    ys = sorted({round(rng.uniform(0, 50), rng.choice([0, 1])) for _ in range(5)})
    return [(i, a, c, b, d, rng.choice(["", "t", "u v"])) for i, ((a, b), (c, d)) in enumerate((x, y) for x in zip(xs, xs[1:]) for y in zip(ys, ys[1:])) if rng.random() < 0.9]


class Box:
    def __init__(self, no, x0, y0, x1, y1, text):
        self.no, self.x0, self.y0, self.x1, self.y1, self.text = no, x0, y0, x1, y1, text
        self.near = dict.fromkeys(["left", "right", "top", "bottom"])


def brute_merge(cells, tol=3.0):
    """Round after round: link all cells, the later link wins; then each small cell goes where most of its side is."""
    cells = [Box(*c) for c in cells]
    edge = lambda v: round(v / tol) * tol
    plan = [("left", "right", "x0", "x1", "y"), ("right", "left", "x1", "x0", "y"), ("top", "bottom", "y0", "y1", "x"), ("bottom", "top", "y1", "y0", "x")]
    rounds = 0
    while True:
        rounds += 1
        for c in cells:
            for side, back, mine, theirs, axis in plan:
                for n in cells:
                    if edge(getattr(n, theirs)) == edge(getattr(c, mine)) and all(abs(getattr(c, f"{axis}{i}") - getattr(n, f"{axis}{i}")) < tol for i in "01"):
                        c.near[side], n.near[back] = n, c
        merged = False
        for c in [c for c in cells if c.x1 - c.x0 < tol or c.y1 - c.y0 < tol]:
            around = [n for n in c.near.values() if n]
            best, most = None, 0
            for n in around:
                tall, wide = max(0, min(c.y1, n.y1) - max(c.y0, n.y0)), max(0, min(c.x1, n.x1) - max(c.x0, n.x0))
                side = next((s for p, q, s in ((c.x1, n.x0, tall), (c.x0, n.x1, tall), (c.y1, n.y0, wide), (c.y0, n.y1, wide)) if abs(p - q) < 1e-6), 0)
                if side > most:
                    best, most = n, side
            if best:
                best.x0, best.y0, best.x1, best.y1 = min(best.x0, c.x0), min(best.y0, c.y0), max(best.x1, c.x1), max(best.y1, c.y1)
                best.text = " ".join(t for t in (best.text, c.text) if t)
                cells.remove(c)
                for n in around:
                    n.near = {s: None if m is c else m for s, m in n.near.items()}
                merged = True
        if not merged:
            return [(c.x0, c.y0, c.x1, c.y1, c.text) for c in cells], rounds


def test_small_cells_merge_as_in_brute_force(spark):
    rng = random.Random(12)
    pages = [small_pages(rng) for _ in range(80)]
    df = spark.createDataFrame([("d", p, *map(lambda v: float(v) if isinstance(v, (int, float)) and v is not c[0] else v, c)) for p, cells in enumerate(pages) for c in cells], f"{KEY}, cell_no int, x0 double, y0 double, x1 double, y1 double, text string")
    got = {}
    for r in merge_small_cells(df).orderBy("page_number", "cell_no").collect():
        got.setdefault(r.page_number, []).append((r.x0, r.y0, r.x1, r.y1, r.text))
    most = 0
    for p, cells in enumerate(pages):
        want, rounds = brute_merge(cells)
        most = max(most, rounds)
        assert got.get(p, []) == want, p
    assert most >= 3  # a second round merged something


def test_chars_meet_cells_as_in_brute_force(spark):
    rng = random.Random(13)
    box = lambda flip: (a := rng.uniform(-30, 90), b := rng.uniform(-30, 90), a + rng.uniform(0, 40), b + rng.uniform(0, 60) * (-1 if rng.random() < flip else 1))
    boxes = [box(0.1) for _ in range(40)] + [(0.0, -1e12, 90.0, 1e12)]
    chars = [(i, chr(97 + i % 26), a, b, a + 2, b + rng.uniform(0, 30) * rng.choice([1, 1, 1, -1])) for i in range(150) for a, b, *_ in [box(0)]]
    found = C.cell_text(spark.createDataFrame([("d", 1, *b) for b in boxes], f"{KEY}, x0 double, y0 double, x1 double, y1 double"), spark.createDataFrame([("d", 1, *c) for c in chars] + [("d", 1, 999, "?", None, None, 1.0, 1.0)], f"{KEY}, seq long, text string, x0 double, y0 double, x1 double, y1 double"))
    got = {tuple(r)[2:6]: r.text for r in found.collect()}
    for b in boxes:
        assert got[b] == "".join(t for _, t, x0, y0, x1, y1 in chars if x0 >= b[0] - 3 and x1 <= b[2] + 3 and y0 >= b[1] - 3 and y1 <= b[3] + 3), b


def test_boxes_from_nearest_sides_are_brute_force(spark):
    rng = random.Random(14)
    points = {(p, rng.randrange(6) * 7, rng.randrange(6) * 9) for p in range(30) for _ in range(rng.randrange(30))}
    df = spark.createDataFrame([("d", p, float(x), float(y)) for p, x, y in points], f"{KEY}, x double, y double")
    got = {(r.page_number, *map(int, r[2:])) for r in C.cell_boxes(df).collect()}
    want = set()
    for p in range(30):
        at = {(x, y) for q, x, y in points if q == p}
        rects = {(a, b, c, d) for a, b in at for c, d in at if a < c and b < d and (a, d) in at and (c, b) in at}
        want |= {(p, *r) for r in rects if not any(r != s and s[0] >= r[0] and s[1] >= r[1] and s[2] <= r[2] and s[3] <= r[3] for s in rects)}
    assert got == want and len(want) > 50


def test_clean_coords_page_by_page(spark):
    rng = random.Random(15)
    rows = [(f"d{p % 3}", p, i, rng.choice("ab"), *(round(rng.uniform(-4, 60), 1) for _ in range(4))) for p in range(40) for i in range(rng.randrange(1, 60))]
    rows += [r[:2] + (r[2] + 500,) + r[3:] for r in rows[::3]]
    sizes = [(f"d{p % 3}", p, 50.0 + p % 2, 40.5) for p in range(39)]
    df = spark.createDataFrame(rows, f"{KEY}, seq long, text string, x0 double, y0 double, x1 double, y1 double")
    got = {tuple(r) for r in C.clean_coords(df, spark.createDataFrame(sizes, f"{KEY}, width double, height double"), ["text", "x0", "y0", "x1", "y1"]).collect()}
    want = {}
    for doc, p, width, height in sizes:
        mine = {}
        for r in rows:
            if r[:2] == (doc, p):
                mine[r[3:]] = min(mine.get(r[3:], 10**9), r[2])
        mine = [[seq, *k] for k, seq in mine.items()]
        for i in (2, 4):
            at = [tuple(r[i : i + 2]) for r in mine]
            label = list(range(len(at)))
            for _ in at:
                for a in range(len(at)):
                    for b in range(a):
                        if (at[a][0] - at[b][0]) ** 2 + (at[a][1] - at[b][1]) ** 2 <= 9:
                            label[a] = label[b] = min(label[a], label[b])
            for a, r in enumerate(mine):
                group = [at[b] for b in range(len(at)) if label[b] == label[a]]
                for j, size in ((0, width), (1, height)):
                    v = sum(g[j] for g in group) / len(group)
                    r[i + j] = v if v < 0 else min(float(int(v + 1e-9)), float(int(size) - 1))
        for seq, *k in mine:
            key = (doc, p, k[0], *(round(v, 6) for v in k[1:]))
            want[key] = min(want.get(key, 10**9), seq)
    assert {(*(g[:3]), *(round(v, 6) for v in g[3:7]), g[7]) for g in got} == {(*k, s) for k, s in want.items()}


def test_first_seen_line_seeds_the_first_cluster(spark):
    from pagegrid.operators import lattice as L
    from pagegrid.schema import Config

    ys = [30.0, 10.0, 12.0, 33.0]
    segments = spark.createDataFrame([("d", 1, "line", i, 0.0, y, 50.0, y) for i, y in enumerate(ys)], f"{KEY}, kind string, seq long, x0 double, y0 double, x1 double, y1 double")
    rects = segments.drop("kind").limit(0)
    lines = L.all_lines(segments, rects)
    heights = lambda config: sorted(r.y0 for r in L.finalise_lines(lines, config).collect())
    assert heights(Config()) == [11.0, 31.5] and heights(Config(first_seen=True)) == [11.0, 30.0, 33.0]


def test_files_are_scanned_and_a_broken_one_is_an_error(spark, tmp_path):
    from pagegrid.plans.document import Documents
    from pagegrid.sources.page_objects import decode, page_subset, scan_documents

    for name, content in (("a.pdf", b"1 2"), ("b.PDF", b"broken"), ("c.txt", b"1"), ("d.Pdf", b"1")):
        (tmp_path / name).write_bytes(content)

    def decoder(doc_id, content):
        for page in content.split():
            n = {"page_number": int(page)}
            yield "pages", n | {"width": 100.0, "height": 100.0}
            for kind, at in (("line", (0, 0, 50, 0)), ("edge", (0, 20, 50, 20)), ("line", (0, 0, 0, 20)), ("edge", (50, 0, 50, 20))):
                yield "segments", n | {"kind": kind} | dict(zip(("x0", "y0", "x1", "y1"), map(float, at)))
            for i, c in enumerate("Date"):
                yield "chars", n | {"text": c, "x0": 5.0 * i + 5, "y0": 5.0, "x1": 5.0 * i + 10, "y1": 15.0}
            yield "chars", n | {"text": "?", "x0": None, "y0": 1.0, "x1": 2.0, "y1": 3.0}
            yield "rects", n | {"x0": 0.0, "y0": 0.0, "x1": float("nan"), "y1": 20.0}

    files = scan_documents(spark, f"file://{tmp_path}")
    assert sorted(r.doc_id for r in files.collect()) == ["a.pdf", "b.PDF", "d.Pdf"]
    frames, errors = decode(files, decoder)
    assert [(r.doc_id, r.stage) for r in errors.collect()] == [("b.PDF", "decode")] and frames["pages"].count() == 3
    assert page_subset(frames, first=1)["pages"].count() == 2 == page_subset(frames, [0])["pages"].count()
    found = Documents(frames)
    assert sorted((r.doc_id, r.page_number, r.text) for r in found.cells.collect()) == [("a.pdf", 1, "Date"), ("a.pdf", 2, "Date"), ("d.Pdf", 1, "Date")]
    assert sorted((r.doc_id, r.num_cells) for r in found.table_structure.collect()) == [("a.pdf", 1), ("d.Pdf", 1)]
    assert sorted((r.doc_id, r.stage, r.message) for r in found.errors().collect()) == [(d, s, f"{n} objects without coordinates") for d, n in (("a.pdf", 2), ("d.Pdf", 1)) for s in ("chars", "rects")]


def test_page_files_and_streams(spark, tmp_path):
    from pagegrid.sources.page_objects import read_frames
    from pagegrid.streaming.incremental import PACKED, follow

    rows = {"pages": [("d", 1, 100.0, 100.0)], "chars": [], "segments": [("d", 1, "edge", *map(float, s)) for s in ((0, 0, 50, 0), (0, 20, 50, 20), (0, 0, 0, 20), (50, 0, 50, 20))], "rects": []}
    columns = {"pages": "width double, height double", "chars": "text string, x0 double, y0 double, x1 double, y1 double", "segments": "kind string, x0 double, y0 double, x1 double, y1 double", "rects": "x0 double, y0 double, x1 double, y1 double"}
    for fmt in ("parquet", "json"):
        for name, found in rows.items():
            spark.createDataFrame(found, f"{KEY}, {columns[name]}").write.format(fmt).save(f"file://{tmp_path}/{fmt}/{name}")
        assert {n: d.count() for n, d in read_frames(spark, f"file://{tmp_path}/{fmt}", fmt).items()} == {n: len(r) for n, r in rows.items()}

    def packed(doc_id):
        segments = [(1, "edge", *map(float, s), None, None) for s in ((0, 0, 50, 0), (0, 20, 50, 20), (0, 0, 0, 20), (50, 0, 50, 20))]
        return spark.createDataFrame([(doc_id, [(1, 100.0, 100.0)], [], segments, [])], PACKED_NULLABLE)

    from pyspark.sql import types as T

    PACKED_NULLABLE = T.StructType([T.StructField(f.name, f.dataType) for f in PACKED])
    source, seen = f"file://{tmp_path}/in", []
    for doc_id in ("a", "b"):
        packed(doc_id).write.mode("append").parquet(source)
        follow(spark, source, f"file://{tmp_path}/checkpoint", lambda documents, n: seen.append((n, sorted(r.doc_id for r in documents.cells.collect())))).awaitTermination()
    assert seen == [(0, ["a"]), (1, ["b"])]


def test_a_model_is_loaded_once_a_worker(spark, tmp_path):
    import sys

    from pagegrid.operators.headers import TransformerEmbedder, known_vectors

    (tmp_path / "sentence_transformers.py").write_text(
        f"import numpy, os\n"
        f"class SentenceTransformer:\n"
        f"    def __init__(self, name):\n"
        f"        open({str(tmp_path)!r} + '/load-' + str(os.getpid()), 'a').write('x')\n"
        f"    def encode(self, texts, normalize_embeddings):\n"
        f"        v = numpy.array([[len(t), 1.0 + t.count('a')] for t in texts])\n"
        f"        return v / numpy.linalg.norm(v, axis=1, keepdims=True)\n"
    )
    spark.sparkContext.addPyFile(str(tmp_path / "sentence_transformers.py"))
    embedder = TransformerEmbedder("some")
    texts = spark.createDataFrame([(f"text {i}",) for i in range(40)] + [("",), ("text 1",)], "text string").repartition(8)
    for _ in range(3):
        found = embedder.embed(texts).collect()
    assert len(found) == 80 and all(sum(r.weight**2 for r in found if r.text == t) == pytest.approx(1) for t in ("text 1", "text 39"))
    vectors = known_vectors(spark, "table", embedder)
    assert vectors.count() == 2 * 141 or vectors.count() > 250
    loads = [p.read_text() for p in tmp_path.glob("load-*")]
    assert loads and all(x == "x" for x in loads)
    sys.modules.pop("sentence_transformers", None)


def test_levels_of_pages_with_and_without_a_grid():
    import numpy as np

    rng = random.Random(16)
    for size, n in ((4, 12), (7, 30), (200, 60), (6, 3)):
        for _ in range(12):
            corners = {(rng.randrange(size), rng.randrange(size), rng.randrange(size), rng.randrange(size)) for _ in range(n)}
            box = np.array([c for c in sorted(corners) if c[0] < c[2] and c[1] < c[3]] or [(0, 0, 1, 1)], float)
            want = {}
            for r in sorted(map(tuple, box), key=lambda r: (r[2] - r[0]) * (r[3] - r[1])):
                want[r] = 1 + max((v for s, v in want.items() if s[0] >= r[0] and s[1] >= r[1] and s[2] <= r[2] and s[3] <= r[3]), default=-1)
            xs, ys = np.unique(box[:, [0, 2]]), np.unique(box[:, [1, 3]])
            at = np.stack([np.searchsorted(v, box[:, i]) for i, v in enumerate((xs, ys, xs, ys))], 1)
            for got in (C._levels(box), C._levels_by_pairs(box), C._levels_by_grid(at, len(xs), len(ys))):
                assert dict(zip(map(tuple, box), got.tolist())) == want


def test_pages_through_the_pdf_library(spark, tmp_path):
    """A library of the same shape stands for the real one, which is not installed here."""
    from pagegrid.sources.page_objects import decode, pdf_decoder

    (tmp_path / "pdfplumber.py").write_text(
        "import contextlib\n"
        "from types import SimpleNamespace as N\n"
        "@contextlib.contextmanager\n"
        "def open(file):\n"
        "    names = file.read().decode().split()\n"
        "    if not names:\n"
        "        raise ValueError('no pages')\n"
        "    box = dict(x0=1, y0=2, x1=3, y1=4)\n"
        "    char = box | dict(text='c', size=9, width=2, height=2, fontname='f')\n"
        "    yield N(pages=[N(page_number=i + 1, width=100, height=50, chars=[char] * len(n), lines=[box], edges=[box, dict(x0=1, x1=2)], rects=[box]) for i, n in enumerate(names)])\n"
    )
    spark.sparkContext.addPyFile(str(tmp_path / "pdfplumber.py"))
    files = spark.createDataFrame([("a", b"xx y"), ("b", b"")], "doc_id string, content binary")
    frames, errors = decode(files, pdf_decoder)
    assert {n: d.count() for n, d in frames.items()} == {"pages": 2, "chars": 3, "segments": 6, "rects": 2}
    assert {(r.kind, r.y0) for r in frames["segments"].collect()} == {("line", 2.0), ("edge", 2.0), ("edge", None)}
    assert [(r.doc_id, r.message) for r in errors.collect()] == [("b", "no pages")]
    first = frames["chars"].orderBy("page_number", "seq").first()
    assert (first.doc_id, first.page_number, first.text, first.size, first.x1) == ("a", 1, "c", 9.0, 3.0)


def test_only_the_keywords_are_broadcast_for_headers(spark):
    """Files of repeated values take few bytes however many rows they have, so the plan may not go by them."""
    from pagegrid.operators import headers
    from pagegrid.plans.document import Documents
    from pagegrid.runtime import scratch_table

    at = "double(100 * (id % 3))"
    table = spark.range(3000).selectExpr(
        "string(id div 3) doc_id", "1 page_number", "int(id % 3) cell_no", "int(id % 3) ordinal", f"{at} x0", "0d y0", f"{at} + 100 x1", "20d y1", "element_at(array('Date', 'x', 'Amount'), int(id % 3) + 1) text"
    )
    found = scratch_table(table, "cells")
    documents = Documents({"pages": found.selectExpr("doc_id", "page_number", "1d width", "1d height")})
    documents.__dict__["cells"] = found
    errors = headers.missing_headers(found.select("doc_id").distinct(), documents.header_row)
    for name, df, rows in (("header_row", documents.header_row, 1000), ("table_structure", documents.table_structure, 1000), ("body", documents.body(), 0), ("counts", documents.counts(), 1000), ("errors", errors, 0)):
        assert df._jdf.queryExecution().sparkPlan().toString().count("BroadcastHashJoin") <= 1, name
        assert df.count() == rows, name


def test_equal_intervals_join_no_earlier_one(spark):
    rows = [(1, 160.0, 169.0), (1, 220.0, 226.0), (1, 400.0, 415.0), (1, 400.0, 415.0), (1, 470.0, 485.0), (2, 5.0, 6.0), (2, 5.0, 6.0), (2, 8.0, 9.0)]
    got = intervals.merge_intervals(spark.createDataFrame(rows, "k int, a double, b double"), ["k"], "a", "b")
    assert sorted(map(tuple, got.collect())) == [*rows[:3], rows[4], (2, 5.0, 9.0)]


def test_equal_lines_change_no_cluster(spark):
    lines = [(1, 160.0, 10.0, 169.0), (1, 220.0, 12.0, 226.0), (1, 400.0, 10.0, 415.0), (1, 470.0, 12.0, 485.0), (2, 5.0, 1.0, 6.0)]
    df = spark.createDataFrame([(k, a, y, b, y) for k, a, y, b in lines * 3], "k int, x0 double, y0 double, x1 double, y1 double")
    got = intervals.cluster_lines(df, "y", keys=["k"])
    assert sorted(map(tuple, got.collect())) == [(k, a, 11.0 if k == 1 else y, b, 11.0 if k == 1 else y) for k, a, y, b in lines]


def test_equal_lines_change_no_first_cluster(spark):
    lines = [(1, 400.0, 12.0, 415.0, 0), (1, 160.0, 5.0, 169.0, 1), (1, 220.0, 7.0, 226.0, 2), (1, 470.0, 12.0, 485.0, 3), (1, 300.0, 13.0, 306.0, 4)]
    df = spark.createDataFrame([(k, a, y, b, y, s) for k, a, y, b, s in lines * 3], "k int, x0 double, y0 double, x1 double, y1 double, seq int")
    got = intervals.cluster_lines(df, "y", keys=["k"], first_seen="seq").select("k", "x0", "y0", "x1")
    assert sorted(map(tuple, got.collect())) == [(1, 160.0, 6.0, 169.0), (1, 220.0, 6.0, 226.0), (1, 300.0, 13.0, 306.0), (1, 400.0, 12.0, 415.0), (1, 470.0, 12.0, 485.0)]


def test_packed_pages_give_the_cells_of_the_plain_way(spark):
    rng = random.Random(23)
    pages, chars, lines = [], [], []
    for p in range(60):
        key = (f"d{p % 7}", p)
        if p % 11:
            pages.append((*key, 200.0 + p, 150.5))
        off = rng.choice([0.0, 0.25, -20.0, 1e6 if p == 5 else 3.0])
        xs, ys = ([off + 20 * v for v in range(rng.randrange(1, 6))] for _ in "xy")
        for n in range(rng.randrange(0, 25)):
            a, b, c, d = rng.choice(xs), rng.choice(xs), rng.choice(ys), rng.choice(ys)
            lines.append((*key, rng.choice(["edge", "line", None]), *rng.choice([(min(a, b), c, max(a, b), c), (a, min(c, d), a, max(c, d)), (b, c, a, c), (a, c, b, d)]), n))
        lines += [(*key, "edge", xs[0], y, xs[-1], y, 99) for y in ys] + [(*key, "edge", x, ys[0], x, ys[-1], None) for x in xs]
        for n in range(rng.randrange(0, 60)):
            x, y = off + rng.uniform(-10, 90), off + rng.uniform(-10, 90)
            chars.append((*key, rng.choice(["a", "é", "", "𝄞b", None]), x, y, x + rng.uniform(-2, 6), y + rng.uniform(-30, 12), rng.choice([n, n, None, n + 2**40])))
    lines.append((None, 1, "edge", 0.0, 0.0, 9.0, 0.0, 1))
    box = ", ".join(f"{c} double" for c in ("x0", "y0", "x1", "y1"))
    rng.shuffle(chars)
    chars = spark.createDataFrame(chars, f"{KEY}, text string, {box}, seq long")
    lines = spark.createDataFrame(lines, f"{KEY}, kind string, {box}, seq long")
    pages = spark.createDataFrame(pages, f"{KEY}, width double, height double")
    plain = C.clean_coords(C.read_segments(lines), pages, ["kind", "x0", "y0", "x1", "y1", "orientation"])
    boxes = C.cell_boxes(C.intersections(plain)).selectExpr(*C.P, "x1 x0", "y1 y0", "x2 x1", "y2 y1")
    for clean in (True, False):
        at = C.clean_coords(chars, pages, ["text", "x0", "y0", "x1", "y1"]) if clean else C.read_objects(chars, ["text", "x0", "y0", "x1", "y1"])
        number = F.row_number().over(C.Window.partitionBy(*C.P).orderBy("x0", F.desc("y0"), "x1", "y1")) - 1
        want = C.cell_text(boxes, at).select(*C.P, number.alias("cell_no"), *C.BOX, F.expr("abs(x1 - x0)").alias("width"), F.expr("abs(y1 - y0)").alias("height"), "text")
        got = C.cells(pages, chars, lines, clean_chars=clean)
        want = sorted(map(tuple, C.document_order(want).collect()))
        assert sorted(map(tuple, got.collect())) == want and len(want) > 200 and sum(r[-2] != "" for r in want) > 50


def test_objects_are_packed_into_few_bytes(spark):
    """A page's chars, as drawn, go into a twentieth of what they take; far apart or odd ones come back as they are."""
    rows = [("d", p, c, 40.0 + 5 * k, 700.0 - 20 * y, 45.0 + 5 * k, 710.0 - 20 * y, 1000 * y + k) for p in range(9) for y in range(10) for k, c in enumerate("1998-05-17 3-MEDIUM O 120345.67")]
    kind = f"{KEY}, text string, x0 double, y0 double, x1 double, y1 double, seq long"
    assert sum(len(r.body) for r in packed(spark.createDataFrame(rows, kind).coalesce(1), 0).collect()) < len(rows) * 2.5
    odd = [("d", 1, t, x, -0.0, 1e300, 0.1, s) for t, x, s in [("a", None, 2**62), (None, -0.0, -(2**62)), ("", 2.0**31, None), ("ö", -(2.0**31), 7)]]
    bodies = [bytes(r.body) for r in packed(spark.createDataFrame(odd, kind).coalesce(1), 0).collect()]
    types = {"text": pa.string()} | dict.fromkeys(("x0", "y0", "x1", "y1"), pa.float64()) | {"seq": pa.int64()}
    assert repr(list(zip(*(c.to_pylist() for c in unpacked(bodies, types)[1].values())))) == repr([r[2:] for r in odd])


def test_pages_of_a_document_are_packed_together(spark):
    """Texts that differ on each page take little more than themselves, and a page's frames one row for some pages."""
    rng = random.Random(31)
    texts = lambda: ["%d-%02d-%02d" % (rng.randrange(1992, 1999), rng.randrange(1, 13), rng.randrange(1, 29)), rng.choice(["1-URGENT", "5-LOW"]), "O", "%.2f" % rng.uniform(1000, 400000)]
    rows = [("d", p, c, 40.0 + 80 * col + 5 * k, 700.0 - 20 * y, 45.0 + 80 * col + 5 * k, 710.0 - 20 * y, (4 * y + col) * 1000 + k) for p in range(1, 9) for y in range(8) for col, t in enumerate(texts()) for k, c in enumerate(t)]
    kind = f"{KEY}, text string, x0 double, y0 double, x1 double, y1 double, seq long"
    found = packed(spark.createDataFrame(rows, kind).coalesce(1), 0).collect()
    assert len(found) == 2 and sum(len(r.body) for r in found) < len(rows) * 0.95


def test_cell_lines_write_no_cells(spark, tmp_path):
    from pagegrid.plans.queries import QUERIES
    from pagegrid.runtime import scratch_mark

    spark.sql("select 7L o_orderkey, 3L o_custkey, 'O' o_orderstatus, 12.5D o_totalprice, timestamp'1997-03-01' o_orderdate, '5-LOW' o_orderpriority").write.parquet(str(tmp_path / "orders.parquet"))
    mark = scratch_mark()
    lines = [r.line for r in QUERIES["cell_sink_lines"](spark, str(tmp_path)).orderBy("ordinal").collect()]
    assert scratch_mark() == mark and len(lines) == 8 and lines[7] == "Pg: 1, Cell 7: Cell(Pg:1, (280, 740)-(380, 760)), Text: '12.50'"


def test_lattice_pages_give_the_cells_of_the_plain_way(spark):
    from pagegrid.plans.document import LatticePages
    from pagegrid.schema import Config

    rng = random.Random(37)
    pages, chars, lines, rects = [], [], [], []
    for p in range(70):
        key = (f"d{p % 7}", p)
        if p % 11:
            pages.append((*key, 200.0 + p, 150.5))
        off = rng.choice([0.0, 0.25, -20.0, 3.0])
        xs, ys = ([off + 18 * v + rng.choice([0, 0, 0, 1, 2, 4.5, 6]) for v in range(rng.randrange(1, 7))] for _ in "xy")
        for n in range(rng.randrange(0, 25)):
            a, b, c, d = rng.choice(xs), rng.choice(xs), rng.choice(ys), rng.choice(ys)
            lines.append((*key, "edge", *rng.choice([(min(a, b), c, max(a, b), c), (a, min(c, d), a, max(c, d)), (b, c, a, c), (a, c, b, d)]), rng.choice([n, None])))
        lines += [(*key, "line", xs[0] - rng.choice([0, 2]), y, xs[-1], y, 99) for y in ys] + [(*key, "edge", x, ys[0], x, ys[-1], 100 + int(x)) for x in xs if rng.random() < 0.8]
        for n in range(rng.randrange(0, 6)):
            a, c = rng.choice(xs), rng.choice(ys)
            rects.append((*key, a, c, a + rng.choice([2.0, 18.0, 36.0]), c + rng.choice([2.0, 18.0]), rng.choice([n, None])))
        for n in range(rng.randrange(0, 60)):
            x, y = off + rng.uniform(-10, 90), off + rng.uniform(-10, 90)
            chars.append((*key, rng.choice(["a", "é", " ", " ", "", "𝄞b", None]), x, y, x + rng.uniform(-2, 6), y + rng.uniform(-8, 12), rng.choice([n, n, None, n + 2**40])))
    box = ", ".join(f"{c} double" for c in C.BOX)
    frames = {"pages": (pages, "width double, height double"), "chars": (chars, f"text string, {box}, seq long"), "segments": (lines, f"kind string, {box}, seq long"), "rects": (rects, f"{box}, seq long")}
    frames = {n: spark.createDataFrame(rows, f"{KEY}, {kind}") for n, (rows, kind) in frames.items()}
    for config in (Config(), Config(first_seen=True)):
        plain = LatticePages(frames, config)
        want = merge_small_cells(plain.found_cells, config.tol).collect()
        found = plain.merged_cells()
        assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
        tidy = lambda rows: sorted((*r[:3], *(round(v, 6) for v in r[3:7]), r[7]) for r in rows)
        assert tidy(found.collect()) == tidy(want) and len(want) > 100 and sum(r.text != "" for r in want) > 40
