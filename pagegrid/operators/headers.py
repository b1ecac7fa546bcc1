"""Header rows and blocks by similarity of their texts to known column titles."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagegrid.functions.geometry import strip
from pagegrid.operators import words as W
from pagegrid.runtime import scratch_table
from pagegrid.schema import BOX, P, Config

# The column titles that a header's texts are compared with, in alphabetical order.
KEYWORDS = [
    "#", "amount", "amt", "available bal.", "available balance", "bal", "balance", "balance amt", "beneficiary", "cheque no.",
    "cheque no/ reference no", "cheque no/reference no", "cheque number", "cheque#", "cheque/ref", "cheque/ref.no.", "cheque/reference#", "chequeno.",
    "chq / ref no.", "chq / ref number", "chq no", "chq no/ref no", "chq-no", "chq.", "chq. no.", "chq./ref. number", "chq./ref.no.",
    "chq./req. number", "chq.no.", "chq/ref", "chq/ref no", "chq/ref.no", "closing bal", "closing balance", "completion time", "cr", "cr amount",
    "cr.", "cr/dr", "credit", "credit amt", "credit or debit", "credit/debit", "credits", "credits/debits", "cust ref no", "customer ref", "date",
    "date id", "date of transaction", "dealer name", "debit", "debit amt", "debit/credit", "debits", "deposit", "deposit amt.", "deposit(cr amount)",
    "deposit(cr)", "deposits", "desc", "description", "details", "details of transaction", "dr", "dr / cr", "dr amount", "dr.", "entry date",
    "inst no", "inst number", "instr no", "instr. no.", "instrmnt number", "instrument id", "instrument no", "instrument number", "instruments",
    "name", "narration", "narrative", "no.", "paid in", "particulars", "party", "payee", "payment", "payment date", "post date", "receipt",
    "receipt no", "recipient", "ref", "ref no", "ref no./cheque no.", "ref num", "ref. no", "ref.no", "reference", "remarks", "running balance",
    "s.no", "serial", "serial number", "sl. no.", "sr no", "sr.no.", "srl", "srno", "total amount", "total amount dr/cr", "tran date", "tran id",
    "trans date", "trans dt", "transaction amount", "transaction credit amount", "transaction date", "transaction debit amount",
    "transaction description", "transaction details", "transaction id", "transaction type", "trn dt", "trn. date", "txn date", "txn type", "type",
    "utr", "utr number", "val date", "value", "value date", "value dt", "withdraw(dr amount)", "withdrawal", "withdrawal (dr)/deposit (cr)",
    "withdrawal amt.", "withdrawals", "withdrawl(dr)", "withdrawn",
]
# Titles that only the header-block profile has, and texts that alone make no header.
BLOCK_KEYWORDS = ["debit/cr"]
COMMON = ["CR", "DR"]


class TextEmbedder(Protocol):
    """Texts as sparse unit vectors: (text, dim, weight)."""

    def embed(self, texts: DataFrame) -> DataFrame: ...


class NGramEmbedder:
    """Counts of character n-grams, of a text between two spaces, scaled to length one.

    Works offline and JVM-side. Equal texts have a similarity of 1; other texts score
    otherwise than with a language model. The empty text has no vector.
    """

    def __init__(self, n: int = 3):
        self.n = n

    def embed(self, texts: DataFrame) -> DataFrame:
        padded = F.concat(F.lit(" "), F.col("text"), F.lit(" "))
        gram = F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - self.n + 1, F.lit(1))), lambda i: F.substring(padded, i, F.lit(self.n)))
        grams = texts.select("text").where("text <> ''").distinct().select("text", F.explode(gram).alias("dim"))
        counts = grams.groupBy("text", "dim").agg(F.count("*").cast("double").alias("c"))
        norm = F.sqrt(F.sum(F.col("c") * F.col("c")).over(Window.partitionBy("text")))
        return counts.select("text", "dim", (F.col("c") / norm).alias("weight"))


_models: dict[str, object] = {}


def loaded_model(name: str):
    """A sentence transformer, loaded by a worker when it is first asked for."""
    if name not in _models:
        from sentence_transformers import SentenceTransformer

        _models[name] = SentenceTransformer(name)
    return _models[name]


class TransformerEmbedder:
    """A sentence transformer, where its library and weights are installed. The empty text has no vector."""

    def __init__(self, name: str = "sentence-transformers/all-MiniLM-L6-v2"):
        self.name = name

    def embed(self, texts: DataFrame) -> DataFrame:
        name = self.name

        def run(batches):
            from pagegrid.operators import headers  # the worker's own module, which keeps the model from task to task

            model = headers.loaded_model(name)
            for df in batches:
                df["v"] = list(model.encode(list(df["text"]), normalize_embeddings=True).astype(float))
                yield df

        dense = texts.select("text").where("text <> ''").distinct().mapInPandas(run, "text string, v array<double>")
        return dense.select("text", F.posexplode("v").alias("dim", "weight"))


_DEFAULT = NGramEmbedder()


def keywords(spark: SparkSession, profile: str = "table") -> DataFrame:
    words = KEYWORDS + (BLOCK_KEYWORDS if profile == "block" else [])
    return spark.createDataFrame([(w,) for w in words], "text string")


_known: dict[tuple, list] = {}


def known_vectors(spark: SparkSession, profile: str = "table", embedder: TextEmbedder | None = None) -> DataFrame:
    """(text, dim, weight) of a profile's keywords, embedded once for each embedder: a fixed list of some 140 texts."""
    embedder = embedder or _DEFAULT
    vectors = embedder.embed(keywords(spark, profile))
    key = (profile, id(embedder))
    if key not in _known:
        _known[key] = [embedder, [tuple(r) for r in vectors.collect()]]  # the embedder stays, and so does its id
    return spark.createDataFrame(_known[key][1], vectors.schema)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two dense vectors of equal length; null if one is zero."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def keyword_similarity(texts: DataFrame, known: DataFrame, embedder: TextEmbedder | None = None) -> DataFrame:
    """text, keyword, similarity for distinct texts and keywords with a dimension in common; others are at 0.

    known: the keywords' texts, or their vectors (known_vectors). Texts meet keywords through shared dimensions, not each with each. The keywords' few
    hundred dimensions are small enough to be broadcast by size.
    """
    embedder = embedder or _DEFAULT
    mine, theirs = embedder.embed(texts), known if "dim" in known.columns else embedder.embed(known)
    pairs = mine.join(theirs.select(F.col("text").alias("keyword"), "dim", F.col("weight").alias("w2")), "dim")
    return pairs.groupBy("text", "keyword").agg(F.sum(F.col("weight") * F.col("w2")).alias("similarity"))


def best_similarity(texts: DataFrame, known: DataFrame, embedder: TextEmbedder | None = None) -> DataFrame:
    """text, similarity: the greatest over all keywords, 0 if there is nothing in common."""
    best = keyword_similarity(texts, known, embedder).groupBy("text").agg(F.max("similarity").alias("similarity"))
    return texts.select("text").distinct().join(best.hint("merge"), "text", "left").select("text", F.coalesce("similarity", F.lit(0.0)).alias("similarity"))


def header_rows(rows: DataFrame, threshold: float = 0.8, embedder: TextEmbedder | None = None) -> DataFrame:
    """The first row of each document, from the top, with a cell more similar to a keyword than the threshold.

    Joins are merged: by the bytes of its files, of which repeated boxes take few, a table of
    millions of rows would count as small and go to the driver to be broadcast.
    """
    lowered = rows.select(*P, "group_no", "y0", F.explode(F.transform("texts", lambda t: F.lower(t))).alias("text"))
    known = known_vectors(rows.sparkSession, "table", embedder)
    scored = lowered.join(best_similarity(lowered, known, embedder).hint("merge"), "text")
    best = scored.groupBy(*P, "group_no").agg(F.max("similarity").alias("max_similarity")).where(F.col("max_similarity") > threshold)
    over = Window.partitionBy("doc_id").orderBy("page_number", "group_no")  # rows count from the top
    first = best.withColumn("_n", F.row_number().over(over)).where("_n = 1").drop("_n")
    return rows.join(first.hint("merge"), [*P, "group_no"])


def table_structure(header: DataFrame) -> DataFrame:
    """doc_id, num_cells, column_x, column_width of the header row's cells, in their order."""
    return header.select(
        "doc_id", F.size("cells").alias("num_cells"), F.transform("cells", lambda c: c["x0"]).alias("column_x"), F.transform("cells", lambda c: F.abs(c["x1"] - c["x0"])).alias("column_width")
    )


def missing_headers(documents: DataFrame, header: DataFrame) -> DataFrame:
    """An error row for each document without a header."""
    return documents.join(header.select("doc_id").hint("merge"), "doc_id", "left_anti").select("doc_id", F.lit("header").alias("stage"), F.lit("no header row").alias("message"))


def header_blocks(chars: DataFrame, segments: DataFrame, config: Config = Config(), embedder: TextEmbedder | None = None) -> DataFrame:
    """P, rank, lower_y, upper_y, confidence, phrases: bands of a page scored as headers.

    The score is the mean over a band's phrases of their greatest similarity, and 0 if
    none has text or all are CR or DR. The first `top_blocks` of a document are kept, by
    falling score, then from below.
    """
    of = W.bands(segments, config.edge_tol)
    found = W.words(W.band_chars(chars, of), config.char_tol)
    found = W.phrases(W.logical_cells(found, config.x_gap, config.y_proximity), config.phrase_tol)
    found = scratch_table(found.withColumn("text", strip(F.col("text"))), "phrases")  # scored by distinct text, and read again
    known = known_vectors(chars.sparkSession, "block", embedder)
    scored = found.join(best_similarity(found.where("text <> ''"), known, embedder).hint("merge"), "text", "left")
    phrase = F.struct("ordinal", F.struct("text", *BOX).alias("p"))
    spoken = F.col("text") != ""
    blocks = scored.groupBy(*W.BAND).agg(
        F.transform(F.array_sort(F.collect_list(phrase)), lambda x: x["p"]).alias("phrases"),
        F.avg(F.when(spoken, F.col("similarity"))).alias("mean"),
        F.every(F.upper("text").isin(COMMON) | ~spoken).alias("common"),
    ).where(F.size("phrases") >= config.min_phrases)
    score = F.when(F.col("common"), 0.0).otherwise(F.coalesce("mean", F.lit(0.0)))
    blocks = blocks.join(of.hint("merge"), W.BAND).withColumn("confidence", score)
    over = Window.partitionBy("doc_id").orderBy(F.desc(F.round("confidence", 9)), "page_number", "lower_y")
    return blocks.withColumn("rank", F.row_number().over(over)).where(F.col("rank") <= config.top_blocks).select(*P, "rank", "lower_y", "upper_y", "confidence", "phrases")
