"""Connected components of an edge table (alternating stars)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagegrid.runtime import dealt, scratch_table


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo")), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 64) -> DataFrame:
    """Smallest reachable node for each node of an undirected edge table.

    Returns (node, component). Nodes without an edge to another node do not appear;
    null ends, loops and repeated edges are ignored. Large-star and small-star rounds
    alternate until the edges form stars. Every minimum is pre-aggregated before its
    shuffle, and each star's minimum is joined from a written table, so that adaptive
    execution can split the partition of a hub node.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    e = scratch_table(pairs.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    before = _signature(e)
    if not before[0]:
        return e.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    for _ in range(max_rounds):
        # Large star: larger neighbours of u move to the smallest of u and its neighbours.
        both = e.unionByName(e.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        least = scratch_table(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "large")
        e = scratch_table(both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(), "edges")
        # Small star: u and its smaller neighbours move to the smallest of them.
        least = scratch_table(e.groupBy("hi").agg(F.min("lo").alias("m")), "small")
        moved = e.join(least.hint("merge"), "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        e = scratch_table(moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct(), "edges")
        after = _signature(e)
        if after == before:
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
        before = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0 to n-1 and links a-b, the smallest node of each one's component."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)  # the labels' own nodes move too, so that paths halve
        np.minimum.at(new, label[b], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def page_components(nodes: DataFrame, links: DataFrame, keys: list[str], node: str) -> DataFrame:
    """nodes with `component`, the smallest node it is connected to within its page; links has keys, a, b.

    Pages are independent and of bounded size, so that each is settled in one go, without
    rounds over the cluster. A node without links is its own component.
    """

    def per_page(own, pairs):
        own = own.sort_values(node, ignore_index=True)
        at = own[node].to_numpy()
        a, b = (np.searchsorted(at, pairs[c].to_numpy()) for c in "ab")
        return own.assign(component=at[_least_labels(len(own), a, b)])

    kind = nodes.schema[node].dataType.simpleString()
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema) + f", component {kind}"
    # Links often come from the same frame: its keys get other names, so that each side has its own.
    renamed = [F.col(k).alias(f"_link_{k}") for k in keys]
    theirs = [f"_link_{k}" for k in keys]
    pairs = dealt(links.select(*renamed, "a", "b"), *theirs).groupBy(*theirs)
    return dealt(nodes, *keys).groupBy(*keys).cogroup(pairs).applyInPandas(per_page, schema)


def whole_pages(df: DataFrame, keys: list[str], work: Callable[[pa.Table, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """work(rows, page) over rows of whole pages; page numbers them from 0. Many pages go in one call.

    Memory follows the largest page: a page that ends in a batch waits for the next batch.
    """
    at = [df.columns.index(k) for k in keys]

    def numbers(table: pa.Table) -> np.ndarray:
        new = np.zeros(len(table), bool)
        for i in at:
            codes = table.column(i).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            new[1:] |= codes[1:] != codes[:-1]
        return np.cumsum(new)

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            page = numbers(table)
            last = int(np.searchsorted(page, page[-1]))
            held = table.slice(last)
            if last:
                yield from work(table.slice(0, last), page[:last]).to_batches()
        if held is not None:
            yield from work(held, np.zeros(len(held), int)).to_batches()

    return dealt(df, *keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _packed(v: np.ndarray) -> np.ndarray:
    """Whole numbers brought close together; neighbours stay neighbours and others stay apart."""
    known, at = np.unique(v, return_inverse=True)
    return np.concatenate([[0], np.cumsum(np.where(np.diff(known) == 1, 1, 2))])[at]


def _near_pairs(page: np.ndarray, x: np.ndarray, y: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of points of a page at most eps apart: points meet those of their own and neighbouring squares of side eps."""
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bx, by = _packed(np.floor(x / eps)), _packed(np.floor(y / eps))
    wide = by.max() + 3
    square = (page * (bx.max() + 3) + bx) * wide + by
    order = np.argsort(square, kind="stable")
    found = [[], []]
    for dx, dy in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1)):
        to = square + dx * wide + dy
        low, high = (np.searchsorted(square[order], to, side) for side in ("left", "right"))
        n = high - low
        a = np.repeat(np.arange(len(x)), n)
        b = order[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]
        close = (a != b) & ((x[a] - x[b]) ** 2 + (y[a] - y[b]) ** 2 <= eps * eps)
        found[0].append(a[close])
        found[1].append(b[close])
    return np.concatenate(found[0]), np.concatenate(found[1])


def cluster_means(page: np.ndarray, x: np.ndarray, y: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """For each point the mean of all points of its page's cluster, repeated ones too."""
    order = np.lexsort((y, x, page))
    p, q, r = page[order], x[order], y[order]
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] != p[:-1]) | (q[1:] != q[:-1]) | (r[1:] != r[:-1])
    spot = np.cumsum(new) - 1
    weight = np.bincount(spot)
    label = _least_labels(len(weight), *_near_pairs(p[new], q[new], r[new], eps))
    total = np.bincount(label, weight)
    out = []
    for v in (q[new], r[new]):
        mean = np.empty(len(p))
        mean[order] = (np.bincount(label, weight * v)[label] / total[label])[spot]
        out.append(mean)
    return out[0], out[1]


def epsilon_clusters(points: DataFrame, keys: list[str], x: str = "x", y: str = "y", eps: float = 3.0) -> DataFrame:
    """keys, x, y, weight, component_x, component_y: distinct points linked when at most eps apart.

    These are the clusters of DBSCAN with one point as its least; a cluster is named by its
    smallest point. Points are counted before the shuffle. Points with a null are left out.
    """
    spots = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*keys, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).agg(F.count("*").alias("weight"))

    def name(table: pa.Table, page: np.ndarray) -> pa.Table:
        px, py = (table.column(c).to_numpy() for c in ("x", "y"))
        order = np.lexsort((py, px, page))
        px, py = px[order], py[order]
        label = _least_labels(len(px), *_near_pairs(page[order], px, py, eps))
        return table.take(pa.array(order)).append_column("component_x", pa.array(px[label])).append_column("component_y", pa.array(py[label]))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spots.schema) + ", component_x double, component_y double"
    return whole_pages(spots, keys, name, schema)


def centroids(points: DataFrame, keys: list[str], x: str = "x", y: str = "y", eps: float = 3.0) -> DataFrame:
    """keys, x, y, cx, cy: the mean of all points of the cluster, repeated ones too."""
    found = epsilon_clusters(points, keys, x, y, eps)
    over = Window.partitionBy(*keys, "component_x", "component_y")
    mean = [(F.sum(F.col(c) * F.col("weight")).over(over) / F.sum("weight").over(over)).alias(f"c{c}") for c in "xy"]
    return found.select(*keys, F.col("x").alias(x), F.col("y").alias(y), *mean)
