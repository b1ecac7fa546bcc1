"""Exact dedup: 128-bit content hash, smallest id, bytes compared inside groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagegrid.runtime import scratch_table

#: Numbers by which rows that may have copies are told from the rest before any is shuffled.
MARKS = 1 << 20
#: What counts as white space: one space stands for each run of these.
SPACE_RUN = r"[\x20\x09-\x0D]+"


def normalise(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def content_hash(text: Column) -> Column:
    """128 bits of a text, as 16 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def split_by_marks(rows: DataFrame, key: Column | str, among: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows whose key is surely not among those of a frame of one column, and the rest, without a shuffle.

    Keys are told apart by one of MARKS numbers, so what is broadcast has a bound at any
    size; with very many keys all rows are in the rest.
    """
    mark = lambda k: F.pmod(F.xxhash64(k), F.lit(MARKS))
    marks = F.broadcast(among.select(mark(F.col(among.columns[0])).alias("__mark")).distinct())
    same = mark(F.col(key) if isinstance(key, str) else key) == marks["__mark"]
    return rows.join(marks, same, "left_anti"), rows.join(marks, same, "left_semi")


def _classes(rows: DataFrame) -> DataFrame:
    """(h, text, keep_id, group_size): one row for each text that differs in any byte.

    The text itself is part of the grouping key, so equal hashes of unequal texts fall
    apart; copies are combined before the shuffle, so a hot text costs a row per task.
    `text` stays only where its hash has several texts.
    """
    apart = rows.groupBy("h", "text").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
    return apart.groupBy("h").agg(F.count("*").alias("texts"), F.min("keep_id").alias("keep_id"), F.min("group_size").alias("group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_fn: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are byte for byte the same after each run of white space
    became one space; a null text is an empty one. The smallest id of a group stays; null
    ids count as largest. Rows that repeat the id that stays, with its text, are all kept.
    An empty table gives an empty result. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), normalise(F.col(text_col)).alias("text"))
    rows = rows.withColumn("h", hash_fn(F.col("text")))
    ids = scratch_table(rows.select("id", "h", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")), "hashed")
    twice = scratch_table(ids.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "repeated")
    alone, _ = split_by_marks(ids, "h", twice)
    alone = alone.select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "text_sha256")
    _, ids = split_by_marks(ids, "h", twice)
    _, rows = split_by_marks(rows, "h", twice)
    by_hash = scratch_table(_classes(rows), "classes")
    out = ids.join(by_hash.where("texts = 1").hint("merge"), "h")
    clashing = by_hash.where("texts > 1").select("h")
    if not clashing.isEmpty():  # then the bytes decide, for these hashes only
        bad = rows.join(clashing.hint("merge"), "h", "left_semi")
        texts = scratch_table(bad.groupBy("h", "text").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size")), "texts")
        more = bad.join(texts.hint("merge"), ["h", "text"]).withColumn("text_sha256", F.sha2(F.col("text").cast("binary"), 256))
        out = out.select("id", "keep_id", "group_size", "text_sha256").unionByName(more.select("id", "keep_id", "group_size", "text_sha256"))
    return out.select("id", "keep_id", "group_size", "text_sha256").unionByName(alone).select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns, whatever their names.

    A repeated row that stays does so once for each time. A null text is an empty one; a
    null id is the largest. An empty table gives an empty one.
    """
    gone = exact_dedup(docs, id_col, text_col).where("not kept").select(F.col(id_col).alias("id"), "text_sha256").distinct()
    gone = scratch_table(gone, "gone")
    sha = F.sha2(normalise(docs[text_col]).cast("binary"), 256)
    alone, shared = split_by_marks(docs, sha, gone.select("text_sha256"))
    return alone.unionAll(shared.join(gone.hint("merge"), shared[id_col].eqNullSafe(gone["id"]) & (sha == gone["text_sha256"]), "left_anti"))
