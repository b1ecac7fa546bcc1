"""Benchmark decontamination: size-partitioned MinHash containment search, then an exact check.

Items are partitioned by their number of distinct shingles. Each partition has a sketch
length: the item's smallest hashes, one more than may be missing at the threshold from the
partition's largest item. A document that contains enough of an item thus holds at least
one hash of its sketch, however long the document is, and no candidate is lost.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagegrid.llm.textwords import ALNUM, Block, blocks, words

SHINGLE = 5
THRESHOLD = 0.8
#: Bytes of benchmark texts that one pass over the documents takes along.
BLOCK_BYTES = 8 << 20
_BITS = 20


def sketch_length(shingles: int, threshold: float) -> int:
    """One more than the shingles an item in the same size partition may miss."""
    largest = (1 << shingles.bit_length()) - 1  # partitions end at powers of two
    return min(shingles, math.floor((1 - threshold) * largest + 1e-9) + 1)


@dataclass
class Index:
    """ids: of the items; shingles: of each item, as texts; widths: words in their shingles."""

    ids: list
    shingles: list[set[bytes]]
    widths: list[int]
    hashes: dict[int, np.ndarray]
    sketch: dict[int, np.ndarray]
    items: dict[bytes, list[int]]
    sketched: dict[int, list[int]]


def build_index(rows: list[tuple], shingle: int, threshold: float) -> Index:
    out = Index([], [], [], {}, {}, {}, {})
    hashes: dict[int, list] = {}
    sketch: dict[int, list] = {}
    for item_id, text in rows:
        data = np.frombuffer((text or "").encode(), np.uint8)
        w = words(Block(0, data, np.array([0, len(data)])), ALNUM)
        n = len(w.starts)
        if not n:
            continue
        width = min(shingle, n)
        h = w.windows(w.hashes(), width)
        own = {w.join(i, width): int(x) for i, x in enumerate(h.tolist())}
        k = len(out.ids)
        out.ids.append(item_id)
        out.shingles.append(set(own))
        out.widths.append(width)
        for s in own:
            out.items.setdefault(s, []).append(k)
        hashes.setdefault(width, []).extend(own.values())
        least = sorted(own.values())[: sketch_length(len(own), threshold)]
        sketch.setdefault(width, []).extend(least)
        for x in least:
            out.sketched.setdefault(x, []).append(k)
    for width in hashes:
        out.hashes[width] = np.unique(np.array(hashes[width], np.uint64))
        out.sketch[width] = np.unique(np.array(sketch[width], np.uint64))
    return out


def _found(h: np.ndarray, among: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Places of h whose hash is among the sorted hashes; marks: a filter by their low bits."""
    at = np.flatnonzero(marks[(h & np.uint64((1 << _BITS) - 1)).astype(np.int64)])
    near = np.minimum(np.searchsorted(among, h[at]), len(among) - 1)
    return at[among[near] == h[at]]


def _marks(among: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << _BITS, bool)
    out[(among & np.uint64((1 << _BITS) - 1)).astype(np.int64)] = True
    return out


def matches(column: pa.Array, index: Index, threshold: float, marks: dict | None = None):
    """(row, item, matched) for each text that contains enough of an item's shingles."""
    marks = marks if marks is not None else {w: _marks(x) for w, x in index.sketch.items()}
    for block in blocks(column):
        w = words(block, ALNUM)
        hashes = w.hashes()
        room = None
        candidates: dict[int, set[int]] = {}
        windows = {}
        for width, sketch in index.sketch.items():
            h = windows[width] = w.windows(hashes, width)
            if not len(h):
                continue
            hit = _found(h, sketch, marks[width])
            if not len(hit):
                continue
            room = w.room() if room is None else room
            hit = hit[room[hit] >= width]
            rows = np.searchsorted(w.of, hit, "right") - 1
            for row, x in set(zip(rows.tolist(), h[hit].tolist())):
                candidates.setdefault(row, set()).update(k for k in index.sketched[x] if index.widths[k] == width)
        for row, items in sorted(candidates.items()):
            held: set[bytes] = set()
            for width in {index.widths[k] for k in items}:
                a, b = int(w.of[row]), int(w.of[row + 1]) - width + 1
                part = windows[width][a:b]
                known = index.hashes[width]
                near = np.minimum(np.searchsorted(known, part), len(known) - 1)
                place = np.flatnonzero(known[near] == part)
                held.update(w.join(a + i, width) for i in place[np.unique(part[place], return_index=True)[1]].tolist())
                if len(np.unique(part[place])) != len(place):  # equal hashes may be of unequal texts
                    held.update(s for s in {w.join(a + i, width) for i in place.tolist()})
            for k in sorted(items):
                n = len(index.shingles[k] & held)
                if n >= threshold * len(index.shingles[k]) - 1e-9:
                    yield block.first + row, k, n


def _item_blocks(items: DataFrame, id_col: str, text_col: str, limit: int) -> list[DataFrame]:
    """The items in blocks of bounded size; a block is all that a pass has in memory."""
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 if total <= limit else math.ceil(2 * total / limit)
    return [rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i) for i in range(n)] if n > 1 else [rows]


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document and item it contains: id, item id, shingles, matched, containment.

    Words are runs of letters and digits: ASCII punctuation, white space and control
    characters end them, A-Z are lower-cased, other characters are kept. An item is held by
    a document if at least `threshold` of its distinct shingles of `shingle` consecutive
    words occur anywhere in it; an item of fewer words is one shingle of all its words; an
    item without words (null, empty) is never held. Documents and items that repeat are
    answered each; an empty table on either side gives no rows. Items go along in blocks of
    bounded size, each against all documents; nothing is shuffled.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type, item_type = rows.schema["id"].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    names = ["id", "item", "shingles", "matched"]
    parts = []
    for part in _item_blocks(items, item_id, item_text, block_bytes):
        index = docs.sparkSession.sparkContext.broadcast(build_index([tuple(r) for r in part.collect()], shingle, threshold))
        item_arrow = items.select(item_id).limit(0).toArrow().schema.field(0).type

        def run(batches, index=index, item_arrow=item_arrow):
            x = index.value
            marks = {w: _marks(s) for w, s in x.sketch.items()}
            for batch in batches:
                found = list(matches(batch.column(1), x, threshold, marks))
                if found:
                    row, k, n = zip(*found)
                    cols = [
                        batch.column(0).take(pa.array(row, pa.int64())),
                        pa.array([x.ids[i] for i in k], item_arrow),
                        pa.array([len(x.shingles[i]) for i in k], pa.int64()),
                        pa.array(n, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(cols, names)

        parts.append(rows.mapInArrow(run, f"id {id_type}, item {item_type}, shingles long, matched long"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_id), "shingles", "matched", (F.col("matched") / F.col("shingles")).alias("containment"))


def drop_contaminated(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", shingle: int = SHINGLE, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of docs that contain none of the items (see contained_items), with all their columns.

    Null and empty texts contain nothing and stay. Repeated rows are judged one by one. An
    empty table of documents gives an empty one; without items all rows stay.
    """
    at = docs.columns.index(text_col)
    for part in _item_blocks(items, item_id, item_text, block_bytes):
        index = docs.sparkSession.sparkContext.broadcast(build_index([tuple(r) for r in part.collect()], shingle, threshold))

        def run(batches, index=index):
            marks = {w: _marks(s) for w, s in index.value.sketch.items()}
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for row, _, _ in matches(batch.column(at), index.value, threshold, marks):
                    keep[row] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
