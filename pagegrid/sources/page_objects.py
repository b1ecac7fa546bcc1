"""Page objects from Parquet or JSON files, or from documents through a decoder."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagegrid.schema import CHARS, PAGES, RECTS, SEGMENTS, validate_schema

FRAMES = {"pages": PAGES, "chars": CHARS, "segments": SEGMENTS, "rects": RECTS}
_ARROW = {"string": pa.string(), "integer": pa.int32(), "long": pa.int64(), "double": pa.float64()}
#: What a decoder yields: frame name and the object's fields.
Decoder = Callable[[str, bytes], Iterable[tuple[str, dict]]]


def read_frames(spark: SparkSession, folder: str, fmt: str = "parquet", suffix: str = "") -> dict[str, DataFrame]:
    """The four frames of a folder, each checked against its schema."""
    out = {}
    for name, schema in FRAMES.items():
        reader = spark.read if fmt == "parquet" else spark.read.schema(T.StructType([T.StructField(f.name, f.dataType) for f in schema]))
        out[name] = validate_schema(reader.format(fmt).load(f"{folder}/{name}{suffix}"), schema)
    return out


def page_subset(frames: dict[str, DataFrame], positions: list[int] | None = None, first: int | None = None) -> dict[str, DataFrame]:
    """Only pages at some 0-based positions, or the first ones; all by default."""
    if positions is not None:
        return {n: d.where((F.col("page_number") - 1).isin(positions)) for n, d in frames.items()}
    return {n: d.where(F.col("page_number") <= first) for n, d in frames.items()} if first is not None else frames


def scan_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, content) of the PDF files of a folder, in any case of the ending."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("doc_id"), "content")


def decode(documents: DataFrame, decoder: Decoder) -> tuple[dict[str, DataFrame], DataFrame]:
    """Frames of decoded documents, and errors (doc_id, stage, message): a broken document fails no job.

    Objects get their ordinal in the stream as `seq`. A document that breaks off leaves its
    error only. Memory follows the largest document.
    """
    fields = {f.name: f.dataType for s in FRAMES.values() for f in s}
    schema = T.StructType([T.StructField("frame", T.StringType()), *(T.StructField(n, t) for n, t in fields.items()), T.StructField("message", T.StringType())])
    arrow = pa.schema([(f.name, _ARROW[f.dataType.typeName()]) for f in schema])

    def rows_of(doc_id: str, content: bytes) -> list[dict]:
        try:
            return [{"frame": frame, "doc_id": doc_id, "seq": seq, **x} for seq, (frame, x) in enumerate(decoder(doc_id, content))]
        except Exception as e:  # whatever the decoder raises becomes the document's error
            return [{"frame": "errors", "doc_id": doc_id, "message": str(e)}]

    def run(batches):
        for batch in batches:
            for doc_id, content in zip(*batch.columns):
                rows = rows_of(doc_id.as_py(), content.as_py())
                for i in range(0, len(rows), 10_000):
                    yield pa.RecordBatch.from_pylist(rows[i : i + 10_000], arrow)

    found = documents.select("doc_id", "content").mapInArrow(run, schema)
    frames = {n: validate_schema(found.where(F.col("frame") == n), s) for n, s in FRAMES.items()}
    return frames, found.where("frame = 'errors'").select("doc_id", F.lit("decode").alias("stage"), "message")


def pdf_decoder(doc_id: str, content: bytes) -> Iterable[tuple[str, dict]]:
    """Objects of a PDF through pdfplumber, where it is installed (not tested here)."""
    import io

    import pdfplumber

    box = ("x0", "y0", "x1", "y1")
    with pdfplumber.open(io.BytesIO(content)) as pdf:
        for page in pdf.pages:
            n = {"page_number": page.page_number}
            yield "pages", n | {"width": float(page.width), "height": float(page.height)}
            for c in page.chars:
                yield "chars", n | {"text": c["text"], **{k: c.get(k) for k in (*box, "size", "width", "height")}}
            for kind, objects in (("line", page.lines), ("edge", page.edges)):
                for o in objects:
                    yield "segments", n | {"kind": kind, **{k: o.get(k) for k in box}}
            for o in page.rects:
                yield "rects", n | {k: o.get(k) for k in box}
