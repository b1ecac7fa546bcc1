"""Near copies: SimHash fingerprints and MinHash bands of word shingles give the candidates, the shingle sets themselves decide."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagegrid.llm.simhash import fingerprints, links
from pagegrid.llm.textwords import SPACED, Block, blocks, mix, powers, words
from pagegrid.operators.graph import connected_components
from pagegrid.runtime import scratch_table

#: Two texts of similarity s meet in one of BANDS runs of ROWS minima: 1 - (1 - s**ROWS)**BANDS, all but 3 in 100,000 at 0.8.
BANDS, ROWS = 20, 4
#: Longs of a text's bitmap of shingles, for large groups.
MAP = 32
_EMPTY = np.uint32(0xFFFFFFFF)
_SEQUENCE = 0xA0761D6478BD642F


def shingles(block: Block, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all texts' shingles back to back, how many each text has, and a hash of each text's words.

    A text of fewer than `size` words has one shingle of all of them; one without words has none.
    """
    w = words(block, SPACED)
    h, n = w.hashes(), np.diff(w.of)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    begin = np.cumsum(count) - count
    at = np.repeat(w.of[:-1] - begin, count) + np.arange(count.sum())
    own = np.repeat(np.minimum(n, size), count)
    out = np.empty(len(at), np.uint64)
    for k in range(1, size + 1):
        some = np.flatnonzero(own == k)
        if len(some):
            out[some] = w.windows(h, k)[at[some]]
    p, q = powers(_SEQUENCE, len(h) + 1)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * p[: len(h)], out=sums[1:])
    return out, count, mix((sums[w.of[1:]] - sums[w.of[:-1]]) * q[w.of[:-1]] + n.astype(np.uint64))


def band_keys(h: np.ndarray, count: np.ndarray, bands: int = BANDS, rows: int = ROWS, seed: int = 42) -> np.ndarray:
    """A row of `bands` keys for each text: each a hash of the least shingles under `rows` permutations."""
    rng = np.random.default_rng(seed)
    low = (h >> np.uint64(32)).astype(np.uint32)
    full = np.flatnonzero(count)
    begin = (np.cumsum(count) - count)[full]
    out = np.empty((len(count), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(count), band + 1, np.uint64)
        for _ in range(rows):
            a, b = rng.integers(1 << 32, size=2, dtype=np.uint32)
            least = np.full(len(count), _EMPTY)
            if len(full):
                least[full] = np.minimum.reduceat((low ^ b) * (a | np.uint32(1)), begin)
            key = mix(key * np.uint64(_SEQUENCE) + least)
        out[:, band] = key
    return out


def sketches(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, node, keys, fp, text): node, a hash of the text's words, stands for all texts of these words; fp is their SimHash."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            fp = pa.array(fingerprints(batch.column(1), shingle).view(np.int64))
            for block in blocks(batch.column(1)):
                part = batch.slice(block.first, len(block))
                h, count, node = shingles(block, shingle)
                keys = pa.FixedSizeListArray.from_arrays(pa.array(band_keys(h, count).view(np.int64).ravel()), BANDS).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(node.view(np.int64)), keys, fp.slice(block.first, len(block)), part.column(1)], ["id", "node", "keys", "fp", "text"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, node long, keys array<long>, fp long, text string")


def _sets(column: pa.Array, shingle: int) -> list[np.ndarray]:
    out = []
    for block in blocks(column):
        h, count, _ = shingles(block, shingle)
        out += [np.unique(x) for x in np.split(h, np.cumsum(count)[:-1])]
    return out


def similarities(pairs: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """(a, b, similarity): the shared shingles among all distinct ones of two texts; 1 if neither has any."""
    one, two = (texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")).hint("merge") for c in "ab")
    both = scratch_table(pairs.join(one, "a").select("a", "b", "text_a"), "sides").join(two, "b").select("a", "b", "text_a", "text_b")

    def run(batches):
        for batch in batches:
            found = []
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                for x, y in zip(_sets(part.column(2), shingle), _sets(part.column(3), shingle)):
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    total = len(x) + len(y) - shared
                    found.append(shared / total if total else 1.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], ["a", "b", "similarity"])

    return both.mapInArrow(run, "a long, b long, similarity double")


def _bitmaps(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, n, bits): how many distinct shingles, and the bits that they set in MAP longs."""

    def run(batches):
        for batch in batches:
            sets = _sets(batch.column(1), shingle)
            bits = np.zeros((len(sets), 64 * MAP), np.uint8)
            for row, x in zip(bits, sets):
                row[(x % np.uint64(64 * MAP)).astype(np.int64)] = 1
            packed = np.packbits(bits, axis=1).view(np.int64)
            found = pa.FixedSizeListArray.from_arrays(pa.array(packed.ravel()), MAP).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in sets], pa.int64()), found], ["node", "n", "bits"])

    return texts.select("node", "text").mapInArrow(run, "node long, n long, bits array<long>")


def _labels(sets: DataFrame, found: DataFrame) -> DataFrame:
    """(node, least, label): each node's component, its own where it has no link."""
    joined = sets.select("node", "least").join(found.hint("merge"), "node", "left")
    return scratch_table(joined.select("node", "least", F.coalesce("component", "node").alias("label")), "labels")


def by_fingerprint(sets: DataFrame, distance: int) -> DataFrame:
    """Candidates (a, b), nodes whose SimHash differs in at most `distance` bits; one node stands for all of its fingerprint."""
    prints = scratch_table(sets.groupBy("fp").agg(F.min("node").alias("first")), "prints")
    same = sets.join(prints.hint("merge"), "fp").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    one, two = (prints.select(F.col("fp").alias(c), F.col("first").alias(f"node_{c}")).hint("merge") for c in "ab")
    close = links(prints.select("fp"), distance).distinct().join(one, "a").join(two, "b")
    return same.unionByName(close.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, least: float = 0.8, bucket: int = 8, distance: int = 2) -> DataFrame:
    """One row per input row: id, component_id, the smallest id reachable over links.

    A-Z are lower-cased; words are runs without white space. Texts link when of the distinct
    shingles of `shingle` words (a shorter text: all its words) of both at least `least` are
    in both. Candidates have SimHash fingerprints of these shingles that differ in at most
    `distance` bits, or meet in a band; each is checked by its whole text. Bands' groups of
    more than `bucket` texts are first compared with one of their own, the hub; then those
    that are not connected yet are compared with each other, so that the components are
    those of all pairs that meet. Distances to the hub (triangle inequality) and bits that
    only one of two texts sets rule out pairs before, never one that would link.
    Null ids link as well, and never name a component that has another id.
    """
    table = scratch_table(sketches(docs, id_col, text_col, shingle), "sketches")
    sets = scratch_table(table.groupBy("node").agg(F.min("id").alias("least"), F.first("keys").alias("keys"), F.first("fp").alias("fp")), "sets")
    keyed = sets.select("node", F.explode("keys").alias("k"))
    turn = F.xxhash64("k")  # each group has a hub of its own
    sizes = keyed.groupBy("k").agg(F.count("*").alias("c"), F.min(F.col("node").bitwiseXOR(turn)).alias("hub")).where("c > 1")
    sizes = scratch_table(sizes.withColumn("hub", F.col("hub").bitwiseXOR(turn)), "buckets")
    members = scratch_table(keyed.join(sizes.hint("merge"), "k").select("k", "c", "hub", "node"), "members")
    small, large = members.where(F.col("c") <= bucket), members.where((F.col("c") > bucket) & (F.col("node") != F.col("hub")))
    few = small.select("k", F.col("node").alias("a")).join(small.select("k", F.col("node").alias("b")).hint("merge"), "k").where("a < b").select("a", "b")
    met = few.unionByName(large.select(F.col("node").alias("a"), F.col("hub").alias("b")))
    pairs = scratch_table(by_fingerprint(sets, distance).unionByName(met).distinct(), "pairs")
    wanted = scratch_table(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "wanted")
    # Texts of the same words have the same shingles: any one of them will do.
    texts = table.select("node", "text").join(wanted.hint("merge"), "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    texts = scratch_table(texts, "texts")
    known = scratch_table(similarities(pairs, texts, shingle), "known")
    close = known.where(F.col("similarity") >= least).select("a", "b")
    labels = _labels(sets, connected_components(close))

    to_hub = known.select(F.col("a").alias("node"), F.col("b").alias("hub"), "similarity")
    placed = large.join(labels.select("node", "label").hint("merge"), "node").join(labels.select(F.col("node").alias("hub"), F.col("label").alias("main")).hint("merge"), "hub")
    placed = scratch_table(placed.join(to_hub.hint("merge"), ["node", "hub"]).select("k", "node", "label", "main", "similarity"), "placed")
    apart = scratch_table(placed.where("label <> main").select("k").distinct(), "apart")
    if not apart.isEmpty():
        also = scratch_table(_unconnected(placed.join(apart.hint("merge"), "k", "left_semi"), texts, sets, shingle, least), "also")
        also = scratch_table(similarities(also, texts, shingle).where(F.col("similarity") >= least).select("a", "b"), "checked")
        labels = _labels(sets, connected_components(close.unionByName(also)))

    name = scratch_table(labels.groupBy("label").agg(F.min("least").alias("component_id")), "least")
    named = scratch_table(labels.join(name.hint("merge"), "label").select("node", "component_id"), "named")
    return table.select("id", "node").join(named.hint("merge"), "node").select(F.col("id").alias(id_col), "component_id")


def _unconnected(placed: DataFrame, texts: DataFrame, sets: DataFrame, shingle: int, least: float) -> DataFrame:
    """Pairs (a, b) of a group and of different labels that may be similar; each pair once, in the least group it shares."""
    own = scratch_table(placed.select("node").distinct(), "own")
    bits = _bitmaps(texts.join(own.hint("merge"), "node", "left_semi"), shingle)
    known = scratch_table(bits.join(sets.select("node", "keys").hint("merge"), "node"), "bitmaps")
    rows = scratch_table(placed.join(known.hint("merge"), "node"), "rows")
    x, y = (rows.select("k", *(F.col(c).alias(f"{c}_{s}") for c in rows.columns if c != "k")) for s in "xy")
    x = x.where("label_x <> main_x")
    differ = sum((F.bit_count(F.col("bits_x")[i].bitwiseXOR(F.col("bits_y")[i])) for i in range(1, MAP)), F.bit_count(F.col("bits_x")[0].bitwiseXOR(F.col("bits_y")[0])))
    once = (F.col("label_y") == F.col("main_y")) | (F.col("node_x") < F.col("node_y"))
    room = (F.col("n_x") + F.col("n_y")) * F.lit((1 - least) / (1 + least)) + 1e-6
    near = F.abs(F.col("similarity_x") - F.col("similarity_y")) <= 1 - least + 1e-9
    first = F.array_min(F.array_intersect("keys_x", "keys_y")) == F.col("k")
    joined = x.join(y.hint("merge"), "k").where((F.col("label_x") != F.col("label_y")) & once & near & (differ <= room) & first)
    return joined.select(F.col("node_x").alias("a"), F.col("node_y").alias("b"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose id names their component, with all their columns: one document of each group.

    Texts that are null, empty or without words are one group. A row with a null id stays
    only if its group has no other. A repeated row that stays does so once for each time.
    An empty table gives an empty one.
    """
    stay = near_copies(docs, id_col, text_col).where(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias("__stay")).distinct()
    stay = scratch_table(stay, "stay")
    return docs.join(stay.hint("merge"), docs[id_col].eqNullSafe(stay["__stay"]), "left_semi")
