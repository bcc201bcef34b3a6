"""Tables between steps: Parquet in the folder that all executors share, dropped together when their results are written."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. Only a local session may do without: it gets a folder that goes with the process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: tables between steps need a folder that all executors share")
        folder = getattr(spark, "_tidemark_scratch", None)
        if folder is None:
            local = tempfile.mkdtemp(prefix="tidemark-")
            atexit.register(shutil.rmtree, local, ignore_errors=True)
            folder = spark._tidemark_scratch = "file://" + local
    return folder.rstrip("/")


class Scratch:
    """Tables of one computation. They end lineage, so a lost executor costs no recomputation beyond its own tasks.

    As a context it drops what is left of them at the end; `kept` ones stay for lazy results, until `release()`.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        for name in list(self.paths):
            self.drop(name)

    def table(self, df: DataFrame, name: str, kept: bool = False) -> DataFrame:
        """The frame, written once; a table of the same name before it goes."""
        path = f"{shared_folder(self.spark)}/tidemark-{name}-{uuid.uuid4().hex}"
        before = self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")  # what was shuffled for a table goes when it is written, not when the driver's garbage does
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.unset(_CLEANUP) if before is None else self.spark.conf.set(_CLEANUP, before)
        if kept:
            _left.append((self.spark, path))
        else:
            self.drop(name)
            self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        if (path := self.paths.pop(name, None)) is not None:
            _delete(self.spark, path)


_left: list[tuple[SparkSession, str]] = []


def keep_path(spark: SparkSession, path: str) -> str:
    """A folder that a lazy result reads, dropped by `release()`."""
    _left.append((spark, path))
    return path


def release() -> int:
    """Drops the tables and files that lazy results of this process read; call it when those have been written."""
    n = len(_left)
    while _left:
        _delete(*_left.pop())
    return n


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
