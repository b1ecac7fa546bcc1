"""New documents as they arrive: each batch of page objects goes through a profile once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pagegrid.plans.document import Documents
from pagegrid.schema import CHARS, PAGES, RECTS, SEGMENTS

#: A document as one row, so that no batch has a part of it.
PACKED = T.StructType(
    [T.StructField("doc_id", T.StringType())]
    + [T.StructField(n, T.ArrayType(T.StructType(list(s)[1:]))) for n, s in (("pages", PAGES), ("chars", CHARS), ("segments", SEGMENTS), ("rects", RECTS))]
)


def unpack(packed: DataFrame) -> dict[str, DataFrame]:
    return {n: packed.selectExpr("doc_id", f"inline({n})") for n in ("pages", "chars", "segments", "rects")}


def follow(spark: SparkSession, source: str, checkpoint: str, write: Callable[[Documents, int], None]) -> StreamingQuery:
    """Run the ruled-page profile on each new batch of packed documents; write gets its number to be idempotent."""
    stream = spark.readStream.schema(PACKED).parquet(source)
    run = lambda batch, n: write(Documents(unpack(batch)), n)
    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
