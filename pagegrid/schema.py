"""Page objects, their types, and the parameters of all profiles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The partition key of every table, join and window.
P = ["doc_id", "page_number"]
BOX = ["x0", "y0", "x1", "y1"]


def _frame(mandatory: dict[str, T.DataType], optional: dict[str, T.DataType] | None = None) -> T.StructType:
    key = [T.StructField("doc_id", T.StringType()), T.StructField("page_number", T.IntegerType())]
    return T.StructType(key + [T.StructField(n, t, False) for n, t in mandatory.items()] + [T.StructField(n, t) for n, t in (optional or {}).items()])


_D = T.DoubleType()
_BOX = dict.fromkeys(BOX, _D)
PAGES = _frame({"width": _D, "height": _D})
CHARS = _frame({"text": T.StringType(), **_BOX}, {"seq": T.LongType(), "size": _D, "width": _D, "height": _D})
SEGMENTS = _frame({"kind": T.StringType(), **_BOX}, {"seq": T.LongType(), "orientation": T.StringType()})
RECTS = _frame(_BOX, {"seq": T.LongType()})


@dataclass(frozen=True)
class Config:
    """tol: points within which coordinates are one; threshold: similarity of a header.

    first_seen: of a lattice page's lines the one that comes first in the stream makes the
    first cluster, with those that chain on from it, as one old pipeline did.
    """

    tol: float = 3.0
    row_tol: float = 1.0
    min_length: float = 5.0
    extension: float = 2.0
    min_overlap_ratio: float = 0.7
    char_tol: float = 2.0
    edge_tol: float = 2.0
    phrase_tol: float = 1.0
    x_gap: float = 6.0
    y_proximity: float = 5.0
    min_phrases: int = 2
    threshold: float = 0.8
    top_blocks: int = 5
    clean_chars: bool = True
    first_seen: bool = False


def validate_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame's columns with their types: a missing mandatory column raises, a missing optional one is null.

    Other columns go. NaN becomes null.
    """
    missing = [f.name for f in schema if f.name not in df.columns and not f.nullable]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    out = []
    for f in schema:
        c = F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        if isinstance(f.dataType, T.DoubleType):
            c = F.when(~F.isnan(c), c)
        out.append(c.alias(f.name))
    return df.select(out)


def split_nulls(df: DataFrame, stage: str) -> tuple[DataFrame, DataFrame]:
    """Rows with all four coordinates, and a row of (doc_id, stage, message) for each document with others."""
    broken = F.greatest(*(F.col(c).isNull() for c in BOX))
    errors = df.where(broken).groupBy("doc_id").agg(F.count("*").alias("n"))
    errors = errors.select("doc_id", F.lit(stage).alias("stage"), F.format_string("%d objects without coordinates", "n").alias("message"))
    return df.where(~broken), errors
