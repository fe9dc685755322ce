"""Writing intermediate tables to the cluster's shared folder.

Several operators read one small result twice (a threshold and the table it is
applied to), or feed a scan with a result of an earlier scan.  ``settle`` cuts
the lineage there: the table is written as Parquet under the session's
checkpoint folder, so a lost executor costs a re-read and never a second scan
of the raw frames, and Catalyst knows its true size when it picks joins.  The
shuffle files behind a written table are removed with the write that made them,
and do not wait for the driver to collect its garbage.

A table stays until it is given back: ``release`` removes one that nothing needs any
more, and ``working`` all that were settled inside it, but for those kept::

    with working() as scope:
        ...
        return scope.keep(result)
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_MARK = "_framewell_settled"
_scopes = threading.local()
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only on local masters."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="framewell-"))
    return sc.getCheckpointDir()


def settle_counted(df: DataFrame, name: str = "table") -> tuple[DataFrame, int]:
    """Settle ``df`` and tell how many rows it has, counted while they are written."""
    if getattr(df, _MARK, False):
        return df, df.count()
    rows = Observation()
    written = settle(df.observe(rows, F.count(F.lit(1)).alias("n")), name)
    return written, rows.get["n"]


def settle(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once and return a reader of the written table."""
    if getattr(df, _MARK, False):
        return df
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    keep = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, keep)
    written = spark.read.schema(df.schema).parquet(path)
    setattr(written, _MARK, path)
    _enter(spark, path)
    return written


def _enter(spark: SparkSession, path: str) -> None:
    scope = getattr(_scopes, "open", None)
    if scope is not None:
        scope.tables[path] = spark


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release(*tables: DataFrame) -> None:
    """Remove settled tables that no later step reads; others are left alone."""
    for df in tables:
        path = getattr(df, _MARK, None)
        if path:
            _remove(df.sparkSession, path)
            scope = getattr(_scopes, "open", None)
            while scope is not None:
                scope.tables.pop(path, None)
                scope = scope.outer


class Scope:
    def __init__(self, outer: Scope | None):
        self.outer = outer
        self.tables: dict[str, SparkSession] = {}

    def keep(self, df: DataFrame, name: str = "result") -> DataFrame:
        """``df`` as a settled table that outlives this scope (and belongs to the one around it)."""
        df = settle(df, name)
        path = getattr(df, _MARK)
        self.tables.pop(path, None)
        if self.outer is not None:
            self.outer.tables[path] = df.sparkSession
        return df


@contextmanager
def working() -> Iterator[Scope]:
    """Tables settled inside are removed at its end, after errors too, unless they are kept."""
    scope = Scope(getattr(_scopes, "open", None))
    _scopes.open = scope
    try:
        yield scope
    finally:
        _scopes.open = scope.outer
        for path, spark in scope.tables.items():
            _remove(spark, path)
