"""Quality classifier: a byte convolutional network over the chunks of whole documents."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagegrid.llm.cnn import Network, Shape, document_scores, train_documents
from pagegrid.llm.sampling import per_label, remainder

#: Training takes about this many texts of each label.
PER_LABEL = 1500


@dataclass
class Model:
    net: Network | None
    prior: float


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_label_: int = PER_LABEL, held: int = 0, by: int = 5) -> Model:
    """Learn from labelled rows whose id's crc32 modulo `by` is not `held`.

    A bounded sample: about `per_label_` texts of label 0 and of label 1. The sample has
    as many of both, so the score is brought back to the labels' own shares. Without a row
    of either label every score is the share of label 1, or 0.5 where there are no labels.
    """
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    marked = marked.where(remainder(F.col("id"), by) != held).distinct()
    sample, counts = per_label(marked, "label", "id", per_label_)
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.5
    if len(counts) < 2:
        return Model(None, prior)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    got = rows.join(F.broadcast(sample), "id").select("label", "text").collect()  # the sample is bounded
    got = sorted((r[0], r[1]) for r in got)
    y = np.array([r[0] for r in got], np.float64)
    if not 0 < y.sum() < len(y):
        return Model(None, prior)
    net = train_documents([t.encode() for _, t in got], y, Shape())
    net.p["out"] = net.p["out"] + np.float32(np.log(prior / (1 - prior)) - np.log(y.mean() / (1 - y.mean())))
    return Model(net, prior)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, score (0 to 1, higher: label 1 likelier).

    Overlapping chunks cover the whole text; a null text is empty and scored as well.
    Repeated rows are answered one by one; an empty table gives no rows; other columns
    are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            m = shared.value
            p = np.concatenate([np.zeros(0), *document_scores(batch.column(1), m.net)]) if m.net else np.full(batch.num_rows, m.prior)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], ["id", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
