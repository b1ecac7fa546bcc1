"""Repeated passages by sparse suffix arrays.

Of all suffixes (a text from some word on) only those at minimisers are retained: the
places with the least hash among `spread` neighbouring word runs. Two copies of a passage of
`min_words` words choose the same place in it, from where they still agree for
min_words - spread + 1 words, the core. The retained suffixes are sorted over the cluster
by core, then by their context: every word of a passage that can choose the place. Neighbours
of the same context match in all those passages. Where neighbours have the core in common
but not the context, the match is extended left and right word by word: each passage that
chooses the place is compared, and of a run of equal contexts only its ends take part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagegrid.llm.textwords import SPACED, Block, Words, blocks, words
from pagegrid.runtime import scratch_table

#: Words of the runs whose hashes choose the places.
RUN = 5


class Places:
    """The minimisers of a block's texts, the hashes that choose and sort them, and the digests that decide."""

    def __init__(self, block: Block, min_words: int, spread: int, hash_bits: int):
        self.hash_bits = np.uint64((1 << hash_bits) - 1)
        self.w: Words = words(block, SPACED)
        self.min_words, self.core_words, self.before = min_words, min_words - spread + 1, spread - 1
        h = self.w.hashes()
        self.run, self.core = (self._padded(h, size) for size in (RUN, self.core_words))
        self.has_full = self.w.room() >= min_words
        #: For each start of a passage of min_words: the least hash among its `spread` first runs.
        self.least = self._slide(self.run, spread, np.minimum)
        self.least[~self.has_full] = 0
        back = self._slide(self.least[::-1], spread, np.maximum)[::-1]  # over the passages that a place can be chosen by
        self.chosen = np.flatnonzero((self.run == back) & (back != 0))
        self._text = self.w.packed() if len(h) else (np.zeros(0, np.uint8),) * 3

    def digests(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """128 bits of the words from first to before last, as two numbers a row."""
        data, starts, ends = self._text
        view, md5 = memoryview(data), hashlib.md5
        found = [md5(view[a:b]).digest() for a, b in zip(starts[first].tolist(), ends[last - 1].tolist())]
        return np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)

    def contexts(self) -> np.ndarray:
        """For each place the digest of all words of the passages that can choose it; zeros where the text ends before."""
        first = self.chosen - self.before
        inside = np.flatnonzero((first >= np.repeat(self.w.of[:-1], np.diff(self.w.of))[self.chosen]) & self.has_full[self.chosen])
        out = np.zeros((len(first), 2), np.int64)
        out[inside] = self.digests(first[inside], self.chosen[inside] + self.min_words)
        return out

    def _padded(self, h: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros(len(h), np.uint64)
        x = self.w.windows(h, size)
        out[: len(x)] = np.maximum(x & self.hash_bits, np.uint64(1))  # zero stands for none
        return out

    @staticmethod
    def _slide(x: np.ndarray, size: int, best) -> np.ndarray:
        """best of x[i : i + size] at each i, or of as many as there are."""
        out, done = x.copy(), 1
        while done < size and done < len(x):
            step = min(done, size - done)
            out[: len(out) - step] = best(out[: len(out) - step], out[step:])
            done += step
        return out


def suffixes(docs: DataFrame, min_words: int, spread: int, hash_bits: int = 64) -> DataFrame:
    """(id, th, pos, core, context, context2): the retained suffixes."""

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(2)):
                p = Places(block, min_words, spread, hash_bits)
                if not len(p.chosen):
                    continue
                row = np.searchsorted(p.w.of, p.chosen, "right") - 1
                at = pa.array(row + block.first)
                pos = (p.chosen - p.w.of[row]).astype(np.int32)
                context = p.contexts()
                cols = [batch.column(0).take(at), batch.column(1).take(at), pa.array(pos), pa.array(p.core[p.chosen].view(np.int64)), *(pa.array(np.ascontiguousarray(context[:, i])) for i in (0, 1))]
                yield pa.RecordBatch.from_arrays(cols, SUFFIX)

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, th long, pos int, core long, context long, context2 long")


SUFFIX = ["id", "th", "pos", "core", "context", "context2"]
#: Whether the neighbour before and after has the same core, and the same context too.
BITS = ["core_before", "context_before", "core_after", "context_after"]


def _neighbours(batches):
    """Compare each sorted suffix with the one before and after; edge marks the first (1) and last (2) of a task."""
    part = TaskContext.get().partitionId()

    def pairs(core, one, two):
        same = core[1:] == core[:-1]
        return same, same & (one[1:] == one[:-1]) & (two[1:] == two[:-1]) & ((one[1:] | two[1:]) != 0)

    def out(table, bits, edge):
        cols = [table.column(i).combine_chunks() for i in range(6)] + [pa.array(x) for x in bits]
        cols += [pa.array(np.array(edge, np.int32)), pa.array(np.full(len(edge), part, np.int32))]
        batch = pa.RecordBatch.from_arrays(cols, [*SUFFIX, *BITS, "edge", "part"])
        return batch.filter(pa.array(bits[0] | bits[2] | (np.array(edge) > 0)))

    held, before = None, None  # the last row so far, which waits for its successor; its bits to the one before
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch] if held is None else [held, batch])
        same = pairs(*(table.column(n).combine_chunks().to_numpy() for n in ("core", "context", "context2")))
        first = before is None
        before = (False, False) if first else before
        b = [np.concatenate([[x], y]) for x, y in zip(before, same)]
        if len(table) > 1:
            edge = np.zeros(len(table) - 1, np.int32)
            edge[0] = first
            yield out(table.slice(0, len(table) - 1), [b[0][:-1], b[1][:-1], *same], edge)
            before = (b[0][-1], b[1][-1])
        elif first:
            before = None
        held = batch.slice(batch.num_rows - 1, 1)
    if held is not None:
        b = before or (False, False)
        yield out(pa.Table.from_batches([held]), [np.array([x], bool) for x in (*b, False, False)], [3 if before is None else 2])


def compared_suffixes(found: DataFrame) -> DataFrame:
    """(id, th, pos, known, open): known: all passages that choose the place have a copy;
    open: some neighbour has the core but another context, so the passages must be compared."""
    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = found.schema["id"].dataType.simpleString()
    order = ["core", "context", "context2", "id", "th", "pos"]  # a hot core is split by context, then by document
    sorted_ = found.repartitionByRange(n, *order).sortWithinPartitions(*order)
    schema = f"id {kind}, th long, pos int, core long, context long, context2 long, {', '.join(f'{x} boolean' for x in BITS)}, edge int, part int"
    rows = scratch_table(sorted_.select(*SUFFIX).mapInArrow(_neighbours, schema), "neighbours")
    # The first and last rows of tasks: what is equal lies together, so a row has an equal
    # neighbour in another task if an earlier or later task begins or ends with such a row.
    ends = rows.where("edge > 0")
    core = ends.groupBy("core").agg(F.min("part").alias("core_low"), F.max("part").alias("core_high"))
    context = ends.groupBy("core", "context", "context2").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    ends = ends.join(core.hint("merge"), "core").join(context.hint("merge"), ["core", "context", "context2"])
    is_first, is_last, full = F.col("edge").isin(1, 3), F.col("edge").isin(2, 3), (F.col("context") != 0) | (F.col("context2") != 0)
    met = [is_first & (F.col("core_low") < F.col("part")), is_first & full & (F.col("low") < F.col("part")), is_last & (F.col("core_high") > F.col("part")), is_last & full & (F.col("high") > F.col("part"))]
    ends = ends.select("id", "th", "pos", *((F.col(x) | here).alias(x) for x, here in zip(BITS, met)))
    bits = {x: F.col(x) for x in BITS}
    known = bits["context_before"] | bits["context_after"]
    open_ = (bits["core_before"] & ~bits["context_before"]) | (bits["core_after"] & ~bits["context_after"])
    return rows.where("edge = 0").select("id", "th", "pos", *BITS).unionByName(ends).select("id", "th", "pos", known.alias("known"), open_.alias("open")).where("known or open")


def _extend(docs: DataFrame, min_words: int, spread: int, hash_bits: int = 64) -> DataFrame:
    """Spans known to repeat, and the passages of open places to compare.

    Rows: (id, th, start, stop, first_byte, last_byte, full, full2), zeros for the known, else
    the digest of the passage.
    """

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(2)):
                p = Places(block, min_words, spread, hash_bits)
                rows, starts, stops, compare = [], [], [], []

                def add(row, start, stop, open_):
                    rows.append(np.full(len(start), row))
                    starts.append(start)
                    stops.append(stop)
                    compare.append(np.full(len(start), open_))

                for i in range(len(block)):
                    row, a, b = block.first + i, int(p.w.of[i]), int(p.w.of[i + 1])
                    at, known, open_ = (batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in (3, 4, 5))
                    at = a + at.astype(np.int64)
                    q = np.sort(at[known])
                    if len(q):
                        new = np.flatnonzero(np.concatenate([[True], q[1:] - spread + 1 > q[:-1] + min_words]))
                        stop = np.concatenate([q[new[1:] - 1], q[-1:]]) + min_words
                        add(row, q[new] - spread + 1, stop, False)
                    left = at[open_]  # the passages that choose an open place: their first run of least hash is there
                    for k in range(spread):
                        s = left - k
                        s = s[(s >= a) & (s + min_words <= b)]
                        s = s[p.run[s + k] == p.least[s]]
                        for j in range(k):
                            s = s[p.run[s + j] != p.least[s]]
                        add(row, s, s + min_words, True)
                row, start, stop, open_ = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, starts, stops, compare))
                if not len(row):
                    continue
                full, at = np.zeros((len(row), 2), np.int64), np.flatnonzero(open_)
                full[at] = p.digests(start[at], stop[at])
                base, byte = p.w.of[row - block.first], block.offsets[row - block.first]
                cols = [
                    batch.column(0).take(pa.array(row)),
                    batch.column(1).take(pa.array(row)),
                    pa.array((start - base).astype(np.int32)),
                    pa.array((stop - base).astype(np.int32)),
                    pa.array(p.w.starts[start] - byte),
                    pa.array(p.w.ends[stop - 1] - byte),
                    *(pa.array(np.ascontiguousarray(full[:, i])) for i in (0, 1)),
                ]
                yield pa.RecordBatch.from_arrays(cols, ["id", "th", "start", "stop", "first_byte", "last_byte", "full", "full2"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, th long, start int, stop int, first_byte long, last_byte long, full long, full2 long")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50, spread: int = 16, hash_bits: int = 64) -> DataFrame:
    """Maximal spans of words all inside passages of min_words words that occur twice or more.

    One row per document and span: id, start_word, end_word (exclusive), start_byte,
    end_byte (exclusive, in the text's UTF-8). Words are runs without white space, A-Z
    lower-cased. The other occurrence may be in the same text, also overlapping. A null
    text is empty; texts with fewer words have no spans. Rows that repeat an id with its
    text are occurrences of their own, answered once. An empty table gives no rows. The
    hashes of `hash_bits` bits only choose, sort and bring together; what is equal is
    decided by digests of the words (MD5, 128 bits), so that fewer bits cost time, not
    results. Memory follows the longest text.
    """
    if not RUN <= min_words - spread + 1:
        raise ValueError("spread is too wide for min_words")
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = scratch_table(suffixes(rows, min_words, spread, hash_bits), "suffixes")
    mine = compared_suffixes(found).groupBy("id", "th").agg(F.collect_set(F.struct("pos", "known", "open")).alias("at"))
    mine = scratch_table(mine.select(F.col("id").alias("id2"), F.col("th").alias("th2"), *(F.col(f"at.{x}").alias(x) for x in ("pos", "known", "open"))), "places")
    joined = rows.join(mine.hint("merge"), rows["id"].eqNullSafe(mine["id2"]) & (rows["th"] == mine["th2"]))
    passages = scratch_table(_extend(joined.select("id", "th", "text", "pos", "known", "open"), min_words, spread, hash_bits), "passages")
    compare = passages.where("full <> 0 or full2 <> 0")
    counts = compare.groupBy("full", "full2").agg(F.count("*").alias("n")).where("n > 1").select("full", "full2")
    counts = scratch_table(counts, "extended")
    spans = passages.where("full = 0 and full2 = 0").select("id", "th", "start", "stop", "first_byte", "last_byte")
    spans = spans.unionByName(compare.join(counts.hint("merge"), ["full", "full2"], "left_semi").select("id", "th", "start", "stop", "first_byte", "last_byte"))
    by_text = Window.partitionBy("id", "th").orderBy("start")
    reach = F.max("stop").over(by_text.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.when(F.col("start") <= reach, 0).otherwise(1))
    spans = spans.withColumn("n", F.sum("new").over(by_text.rowsBetween(Window.unboundedPreceding, 0)))
    merged = spans.groupBy("id", "th", "n").agg(F.min("start").alias("start_word"), F.max("stop").alias("end_word"), F.min("first_byte").alias("start_byte"), F.max("last_byte").alias("end_byte"))
    return merged.select(F.col("id").alias(id_col), "start_word", "end_word", "start_byte", "end_byte")
