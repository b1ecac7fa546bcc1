"""The queries of this folder, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagegrid.llm import language, quality, token_counts
from pagegrid.llm.decontaminate import contained_items
from pagegrid.llm.exact_dedup import exact_dedup
from pagegrid.llm.packing import pack
from pagegrid.llm.repeats import repeated_passages
from pagegrid.llm.sampling import remainder
from pagegrid.llm.simhash import near_dedup
from pagegrid.llm.url_filter import judge
from pagegrid.llm.warc import round_trip
from pagegrid.runtime import attach_workers, scratch_path, scratch_table, settled

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        attach_workers(spark)
        return settled(lambda: f(spark, sf_dir), f.__name__)

    QUERIES[f.__name__] = run
    return f


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"))


ORACLES["op1_exact_dedup"] = r"""
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
    FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
    WINDOW g AS (PARTITION BY t)
"""


@query
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(_table(spark, sf_dir, "documents"))


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "shingles", "matched")


ORACLES["op4_decontaminate"] = r"""
    WITH split AS (
        SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
    ), worded AS (
        SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM split
    ), widths AS (
        SELECT id, w, least(5, len(w)) AS k FROM worded WHERE kind = 'b' AND len(w) > 0
    ), items AS (
        SELECT DISTINCT id, k, array_to_string(w[i : i + k - 1], ' ') AS s FROM (SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM widths)
    ), docs AS (
        SELECT DISTINCT id, k, array_to_string(w[i : i + k - 1], ' ') AS s
        FROM (SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM worded, (SELECT DISTINCT k FROM items) WHERE kind = 'd')
    ), sizes AS (SELECT id, count(*) AS shingles FROM items GROUP BY id)
    SELECT docs.id AS doc_id, items.id AS item_id, shingles, count(*) AS matched
    FROM docs JOIN items USING (k, s) JOIN sizes ON sizes.id = items.id
    GROUP BY docs.id, items.id, shingles HAVING count(*) >= 0.8 * shingles
"""


@query
def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents")).select("doc_id", "start_word", "end_word")


ORACLES["op8_repeated_passages"] = r"""
    WITH worded AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x20\x09-\x0D]+') AS w FROM documents
    ), passages AS (
        SELECT doc_id, i - 1 AS a, sha256(array_to_string(w[i : i + 49], ' ')) AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM worded)
    ), twice AS (
        SELECT doc_id, a FROM (SELECT doc_id, a, count(*) OVER (PARTITION BY s) AS n FROM passages) WHERE n > 1
    ), marked AS (
        SELECT doc_id, a, CASE WHEN a <= lag(a) OVER (PARTITION BY doc_id ORDER BY a) + 50 THEN 0 ELSE 1 END AS new FROM twice
    ), islands AS (
        SELECT doc_id, a, sum(new) OVER (PARTITION BY doc_id ORDER BY a) AS n FROM marked
    )
    SELECT doc_id, CAST(min(a) AS INTEGER) AS start_word, CAST(max(a) + 50 AS INTEGER) AS end_word FROM islands GROUP BY doc_id, n
"""


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))
    held_out = (remainder(F.col("doc_id"), 5) == 0).alias("held_out")
    return scored.select("doc_id", held_out, "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs))
    return found.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_table(spark, sf_dir, "pages"))


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in; blank ones go and come back; the end of the text is counted too and then not; a batch comes again."""
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents")
    counted = scratch_table(token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), "byte_bpe_50k"), "counted")
    rollup = token_counts.Rollup(spark, scratch_path(spark, "rollup"))
    rollup.commit("load", token_counts.inserts(counted))
    rollup.commit("blank", token_counts.deletes(counted.where("blank")))
    rollup.commit("ends", token_counts.revisions(counted.where("not blank"), F.col("tokens") + 1))
    rollup.commit("back", token_counts.inserts(counted.where("blank")))
    ended = counted.where("not blank").withColumn("tokens", F.col("tokens") + 1)
    rollup.commit("plain", token_counts.revisions(ended, F.col("tokens") - 1))
    rollup.commit("load", token_counts.inserts(counted))
    return rollup.totals()


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_table(spark, sf_dir, "pages"))


ORACLES["op7_warc"] = r"""
    WITH hashed AS (
        SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages
    ), letters AS (
        SELECT h, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST(
            256 * (strpos('0123456789abcdef', substr(h || '00', (5 * i) // 4 + 1, 1)) - 1) + 16 * (strpos('0123456789abcdef', substr(h || '00', (5 * i) // 4 + 2, 1)) - 1)
            + strpos('0123456789abcdef', substr(h || '00', (5 * i) // 4 + 3, 1)) - 1 AS BIGINT) >> CAST(7 - (5 * i) % 4 AS BIGINT)) & 31), 1)), '') AS d
        FROM (SELECT DISTINCT h FROM hashed)
    )
    SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM hashed JOIN letters USING (h)
"""
