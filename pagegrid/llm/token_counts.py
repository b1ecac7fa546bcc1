"""Token counts: totals by source, language and tokenizer version, kept by signed deltas."""

from __future__ import annotations

import base64
import uuid
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: How byte-level rank files split a text before their merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEYS = ["source", "lang", "tokenizer"]
SUMS = ["documents", "tokens"]
_encodings: dict[str, tiktoken.Encoding] = {}


def encoding(path: str) -> tiktoken.Encoding:
    if path not in _encodings:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines())}
        _encodings[path] = tiktoken.Encoding(Path(path).name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def count_tokens(docs: DataFrame, path: str, version: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """(id, source, lang, tokenizer, tokens, blank): the tokens of each whole text; a null text has none.

    Null sources and languages are groups of their own. Repeated rows are counted one by
    one; an empty table gives no rows; columns of other names are not read.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col(lang_col).cast("string").alias("lang"), text.alias("text"))

    def run(batches):
        for batch in batches:
            own = encoding(path)
            texts = [t.as_py() or "" for t in batch.column(3)]
            n = pa.array([len(own.encode_ordinary(t)) for t in texts], pa.int64())
            blank = pa.array([not t.strip() for t in texts])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], n, blank], ["id", "source", "lang", "tokens", "blank"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, source string, lang string, tokens long, blank boolean").withColumn("tokenizer", F.lit(version))


def inserts(counted: DataFrame) -> DataFrame:
    """Changes (before, after): documents that are new."""
    after = F.struct(*KEYS, "tokens")
    return counted.select(F.when(F.lit(False), after).alias("before"), after.alias("after"))


def deletes(counted: DataFrame) -> DataFrame:
    """Changes: documents that go; their rows as they were counted."""
    return inserts(counted).select(F.col("after").alias("before"), F.col("before").alias("after"))


def revisions(counted: DataFrame, tokens) -> DataFrame:
    """Changes: documents whose count becomes `tokens`."""
    before = F.struct(*KEYS, "tokens")
    return counted.select(before.alias("before"), F.struct(*KEYS, tokens.cast("long").alias("tokens")).alias("after"))


def delta(changes: DataFrame) -> DataFrame:
    """Signed sums of changes by source, language and tokenizer version.

    What a document was counts negative, what it is positive; either may be null. Sums are
    made before the shuffle, so a source with most rows costs a row per task.
    """
    signed = changes.select(F.explode(F.array(F.struct(F.lit(-1).alias("sign"), F.col("before").alias("x")), F.struct(F.lit(1).alias("sign"), F.col("after").alias("x")))).alias("c"))
    signed = signed.where("c.x is not null").select("c.sign", "c.x.*")
    return signed.groupBy(*KEYS).agg(F.sum(F.col("sign").cast("long")).alias("documents"), F.sum(F.col("sign") * F.col("tokens")).alias("tokens"))


@dataclass
class Rollup:
    """Totals in a folder that all nodes share.

    `data` has a folder of signed sums for each try of a commit; `commits` has a file for
    each batch, which names the one that counts. Folders that no file names are nothing.
    """

    spark: SparkSession
    folder: str

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.folder).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _publish(self, data: str, at: str) -> bool:
        """Write the batch's file; False if there is one. The rename never replaces a file, and is one step on HDFS."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        fs, mine, there = self._fs(), self._path(f"{data}.try"), self._path(at)
        out = fs.create(mine, True)
        out.write(bytearray(data.rpartition("/")[2].encode()))
        out.close()
        fs.mkdirs(there.getParent())
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
        keep = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(fs.makeQualified(mine), fs.makeQualified(there), keep)
        except Exception:
            fs.delete(mine, False)
            if not fs.exists(there):
                raise
            return False
        return True

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of changes once; False and no effect if that batch is there already.

        Each try writes its sums to a folder of its own and then a file that names it, if
        the batch has none. So a batch counts as a whole or not at all and once, however
        often, or by how many at a time, its commit is tried or broken off.
        """
        if not batch or any(not (c.isalnum() or c in "-_") for c in batch):
            raise ValueError(f"not a batch name: {batch!r}")
        at = f"{self.folder}/commits/{batch}"
        if self._fs().exists(self._path(at)):
            return False
        data = f"{self.folder}/data/{batch}-{uuid.uuid4().hex}"
        delta(changes).write.parquet(data)
        if not self._publish(data, at):
            self._fs().delete(self._path(data), True)
            return False
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, documents, tokens; what has come to nothing is left out. No commits: no rows."""
        schema = "source string, lang string, tokenizer string, documents long, tokens long"
        commits = f"{self.folder}/commits"
        if not self._fs().exists(self._path(commits)):
            return self.spark.createDataFrame([], schema)
        names = [r[0] for r in self.spark.read.text(commits).collect()]  # one for each batch
        found = [f"{self.folder}/data/{n}" for n in names]
        sums = self.spark.read.schema(schema).parquet(*found).groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in SUMS))
        return sums.where("documents <> 0 or tokens <> 0")
