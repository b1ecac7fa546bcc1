"""SimHash near-dedup: fingerprints of word shingles, pigeonhole blocks, Hamming check."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagegrid.llm.textwords import SPACED, blocks, words
from pagegrid.operators.graph import connected_components
from pagegrid.runtime import scratch_table

#: Constants of the XXH64 format.
P1 = np.uint64(0x9E3779B185EBCA87)
P2 = np.uint64(0xC2B2AE3D27D4EB4F)
P3 = np.uint64(0x165667B19E3779F9)
P4 = np.uint64(0x85EBCA77C2B2AE63)
P5 = np.uint64(0x27D4EB2F165667C5)


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of many short slices of data. Slices of 32 bytes or more go to the library."""
    size = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    four = np.ndarray(len(data) + 1, "<u4", padded, strides=(1,))
    order = np.argsort(size.astype(np.uint16) if len(size) and size.max() < 65536 else size, kind="stable")
    at, size = starts[order], size[order]
    h = np.full(len(at), seed, np.uint64) + P5 + size.astype(np.uint64)
    for lane in range(3):
        k = int(np.searchsorted(size, 8 * lane + 8))  # the slices from k on have this lane
        if k == len(at):
            break
        x = _turn(eight[at[k:] + 8 * lane] * P2, 31) * P1
        h[k:] = _turn(h[k:] ^ x, 27) * P1 + P4
    rest, at = size & 7, at + (size & ~7)
    some = np.flatnonzero(rest >= 4)
    h[some] = _turn(h[some] ^ four[at[some]].astype(np.uint64) * P1, 23) * P2 + P3
    at, rest = at + (rest & 4), rest & 3
    for i in range(3):
        some = np.flatnonzero(rest > i)
        h[some] = _turn(h[some] ^ padded[at[some] + i].astype(np.uint64) * P5, 11) * P1
    h ^= h >> np.uint64(33)
    h *= P2
    h ^= h >> np.uint64(29)
    h *= P3
    h ^= h >> np.uint64(32)
    out = np.empty_like(h)
    out[order] = h
    for i in order[np.searchsorted(size, 32) :].tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), seed)
    return out


def _majority(h: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """For each run of count hashes from begin on, the bits set in over half of them."""
    out = np.zeros(len(begin), np.uint64)
    full = np.flatnonzero(count)
    if not len(full):
        return out
    begin, count = begin[full], count[full]
    parts = (count + 254) // 255  # eight counters in a word: at most 255 hashes a part
    first = np.cumsum(parts) - parts
    cut = np.repeat(begin, parts) + 255 * (np.arange(parts.sum()) - np.repeat(first, parts))
    found = np.zeros(len(full), np.uint64)
    low = np.uint64(0x0101010101010101)
    for bit in range(8):
        sums = np.add.reduceat((h >> np.uint64(bit)) & low, cut)
        per = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        over = 2 * per > count[:, None]
        for byte in range(8):
            found |= over[:, byte].astype(np.uint64) << np.uint64(8 * byte + bit)
    out[full] = found
    return out


def fingerprints(column: pa.Array, shingle: int = 3, seed: int = 42) -> np.ndarray:
    """SimHash of each text; see near_dedup."""
    out = [np.zeros(0, np.uint64)]
    for block in blocks(column):
        w = words(block, SPACED)
        if not len(w.starts):
            out.append(np.zeros(len(block), np.uint64))
            continue
        data, starts, ends = w.packed()
        n = np.diff(w.of)
        count = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
        begin = np.cumsum(count) - count
        at = np.repeat(w.of[:-1] - begin, count) + np.arange(count.sum())
        last = np.minimum(at + shingle, np.repeat(w.of[1:], count)) - 1
        out.append(_majority(xxh64(data, starts[at], ends[last], seed), begin, count))
    return np.concatenate(out)


def fingerprint_table(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(id, fp): fp holds the unsigned fingerprint's bits in a long."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            fp = fingerprints(batch.column(1), shingle, seed).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], ["id", "fp"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def split(mask: int, distance: int) -> list[int]:
    """Masks that share more bits than `mask`: its open bits in distance + 2 blocks, any two of them shared as well."""
    rest = [i for i in range(64) if not mask >> i & 1]
    n = distance + 2
    parts = [sum(1 << i for i in rest[len(rest) * k // n : len(rest) * (k + 1) // n]) for k in range(n)]
    return sorted({mask | x | y for x, y in combinations(parts, 2)})


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(prints: DataFrame, distance: int = 2, bucket: int = 48) -> DataFrame:
    """Links (a, b) of all pairs of distinct fingerprints that differ in at most `distance` bits.

    The 64 bits are split into distance + 2 blocks; a close pair has two of them in common,
    so it meets in the bucket of those two, and its Hamming distance is verified. A bucket
    of more than `bucket` fingerprints is not joined: the bits that its members may differ
    in are split into blocks again, where a close pair has again two in common, until all
    buckets are that small or hold all values of fewer bits than there are blocks. So every
    pair is found in the same way, and no row meets more than about `bucket` others there.
    """
    if not 0 <= distance < 32:
        raise ValueError("distance must be from 0 to 31")
    spark, masks, found = prints.sparkSession, split(0, distance), None
    level = prints.select("fp", F.explode(F.array(*(F.lit(_signed(m)) for m in masks))).alias("mask"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    while True:
        keyed = level.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
        sizes = scratch_table(keyed.groupBy("mask", "key").agg(F.count("*").alias("c")).where("c > 1"), "buckets")
        members = scratch_table(keyed.join(sizes.hint("merge"), ["mask", "key"]), "members")
        rest = max(64 - m.bit_count() for m in masks)
        last = rest < distance + 2 or 1 << rest <= bucket
        small = members if last else members.where(F.col("c") <= bucket)
        one, two = (small.select("mask", "key", F.col("fp").alias(x)) for x in "ab")
        pairs = one.join(two.hint("merge"), ["mask", "key"]).where((F.col("a") < F.col("b")) & close).select("a", "b")
        found = pairs if found is None else found.unionByName(pairs)
        large = members.where(F.col("c") > bucket)
        if last or large.isEmpty():
            return found
        finer = {m: split(m, distance) for m in masks}
        table = spark.createDataFrame([(_signed(m), _signed(x)) for m, xs in finer.items() for x in xs], "mask long, finer long")
        # The masks follow from the distance alone: a few hundred rows.
        level = large.join(F.broadcast(table), "mask").select("fp", F.col("finer").alias("mask")).distinct()
        masks = sorted({x for xs in finer.values() for x in xs})


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2, seed: int = 42) -> DataFrame:
    """One row per input row: id, fingerprint, component_id.

    A-Z are lower-cased; words are runs without white space; shingles of `shingle` words,
    repeats included, are joined by spaces (a shorter text: all its words; none: the
    fingerprint is zero and links like any other). A bit of the fingerprint is set if over
    half of the shingles' XXH64 have it. Documents link at `distance` or fewer differing
    bits; component_id is the smallest id reachable. A null text counts as empty. Null ids
    link as well, and never name a component that has another id. Repeated rows are
    answered one by one. An empty table gives an empty result.
    """
    table = scratch_table(fingerprint_table(docs, id_col, text_col, shingle, seed), "prints")
    prints = scratch_table(table.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    found = connected_components(links(prints, distance))
    member = prints.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    member = scratch_table(member, "members")
    least = scratch_table(member.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    named = scratch_table(member.join(least.hint("merge"), "component").select("fp", "component_id"), "named")
    return table.join(named.hint("merge"), "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
