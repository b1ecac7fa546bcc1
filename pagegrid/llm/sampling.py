"""Bounded samples of labelled texts for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DEALT = 1 << 40


def remainder(id_col: Column, by: int) -> Column:
    """crc32 of the id as text, modulo `by`; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % by


def per_label(rows: DataFrame, label: str, key: str, most: int) -> tuple[DataFrame, dict]:
    """About `most` rows of each label, by the key's hash, and all labels' counts.

    The choice depends on the keys alone, not on partitions; no label's rows meet in a task.
    """
    counts = rows.groupBy(label).agg(F.count("*").alias("n")).collect()
    if not counts:
        return rows.limit(0), {}
    share = F.create_map(*[x for r in counts for x in (F.lit(r[0]), F.lit(min(_DEALT, _DEALT * most // r[1])))])
    dealt = F.pmod(F.xxhash64(F.lit(42), F.col(key)), F.lit(_DEALT))
    return rows.where(dealt < share[F.col(label)]), {r[0]: r[1] for r in counts}
