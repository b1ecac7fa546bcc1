"""Language ID: a byte convolutional network over windows of fixed length."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagegrid.llm.cnn import Network, Shape, class_scores, train_windows
from pagegrid.llm.sampling import per_label, remainder

NO_LANGUAGE = "und"
#: Training takes about this many texts of each language.
PER_LANGUAGE = 500


@dataclass
class Model:
    languages: list[str]
    net: Network | None


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, held: int = 1, by: int = 3) -> Model:
    """Learn from rows with a language whose id's crc32 modulo `by` is not `held`.

    A sample bounded by language: about `per_language` texts of each, however many there are.
    Without any such row the model has no language, and all texts are `und`.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where("lang is not null and text is not null").where(remainder(F.col("id"), by) != held)
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    sample, counts = per_label(rows, "lang", "id", per_language)
    got = sorted((r[0], r[1]) for r in sample.select("lang", "text").collect())
    languages = sorted({lang for lang, _ in got})
    if not languages:
        return Model([], None)
    y = np.array([languages.index(lang) for lang, _ in got])
    return Model(languages, train_windows([t.encode() for _, t in got], y, len(languages), Shape()))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def predict(column: pa.Array, model: Model) -> tuple[list[str], np.ndarray]:
    letters = np.array([has_letter(t.as_py()) for t in column], bool)
    if model.net is None:
        return [NO_LANGUAGE] * len(column), np.zeros(len(column))
    p = np.concatenate([np.zeros((0, len(model.languages))), *class_scores(column, model.net)])
    best = p.argmax(1)
    lang = [model.languages[k] if ok else NO_LANGUAGE for k, ok in zip(best.tolist(), letters.tolist())]
    return lang, np.where(letters, p.max(1), 0.0)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, lang_pred, score (the prediction's probability, 0 for `und`).

    Windows of fixed length cover the whole text. A text that is null or has no letter is
    `und`. Repeated rows are answered one by one; an empty table gives no rows; other
    columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            lang, score = predict(batch.column(1), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["id", "lang_pred", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def keep_known(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of docs with a language of a probability of at least `least`, with all their columns.

    Texts that are null or have no letter go. Ids are not read. Repeated rows are judged one
    by one; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            lang, score = predict(batch.column(at), shared.value)
            yield batch.filter(pa.array((np.array(lang, object) != NO_LANGUAGE) & (score >= least), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
