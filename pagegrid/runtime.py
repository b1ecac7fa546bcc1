"""Session helpers shared by all operators: scratch data and worker imports."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_scratch: dict[str, SparkSession] = {}
BATCH_SIZE, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def attach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, and get rows in small batches.

    On a cluster the package is installed or shipped with --py-files; a path that
    does not exist there is ignored. Batches of Spark's default size hold 64 MB, several
    times over on both sides of the pipe; any other size that the session has set stays.
    """
    if spark.conf.get(BATCH_SIZE, None) == "67108864b":
        spark.conf.set(BATCH_SIZE, BATCH_BYTES)
    root = str(Path(__file__).resolve().parent.parent)
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, by what Hadoop takes as default: other readers may take another."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share.

    Where it is unset, a local session (tests) takes a temporary folder; a cluster, whose
    nodes would not see it, raises.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="pagegrid-")
        spark.sparkContext.setCheckpointDir(found)
    return qualified(spark, found).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder for this application; those of one that was killed are found by its name."""
    path = f"{shared_dir(spark)}/pagegrid/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    _scratch[path] = spark
    return path


def scratch_table(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """make()'s result, written if it stands on scratch data, which is released then; else as it is."""
    mark = scratch_mark()
    found = make()
    if set(_scratch) == mark:
        return found
    found = scratch_table(found, label)
    release_scratch(mark, keep=1)
    return found


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df by its keys in as many partitions as the session shuffles to, for Python to work on.

    Adaptive execution joins partitions by their bytes, so that a few tasks would get all
    groups of a small table, however long Python takes for each; a given number stays.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def scratch_mark() -> set[str]:
    """The scratch data there is now; see release_scratch."""
    return set(_scratch)


def release_scratch(mark: set[str] = frozenset(), keep: int = 0) -> None:
    """Delete the scratch data made since `mark`, but for the last `keep` ones.

    Only for results that have been written out: a DataFrame over released data fails.
    """
    made = [path for path in _scratch if path not in mark]
    for path in made[: len(made) - keep]:
        spark = _scratch.pop(path)
        try:
            jvm = spark.sparkContext._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session may be gone; the folder is scratch space
            continue


atexit.register(release_scratch)
