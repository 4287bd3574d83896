"""Written intermediate tables: computed once, read many times, safe against lost executors."""

from __future__ import annotations

import functools
import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
#: folders made inside the running `cleans_up` call, if there is one
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="starmart-")
    return _local_roots[app]


def new_folder(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    path = f"{staging_root(spark)}/starmart/{app}/{label}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def cleans_up(function):
    """For functions (spark, ...) whose writes are done when they return: deletes what they staged, also if they fail.

    Not for functions that return a frame, which would still read it.
    """

    @functools.wraps(function)
    def run(spark: SparkSession, *args, **kwargs):
        made: list[str] = []
        token = _made.set(made)
        try:
            return function(spark, *args, **kwargs)
        finally:
            _made.reset(token)
            for path in made:
                delete_folder(spark, path)

    return run


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet and return a scan of it.

    Used where several branches read the same expensive result (a join, a decode, an
    aggregate): the scan is columnar and prunes columns per branch, and a lost executor
    costs a re-read and not a recomputation.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
