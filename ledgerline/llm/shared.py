"""Small helpers that several training-data operators use."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_open: ContextVar[list[DataFrame] | None] = ContextVar("tables of the open scratch", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Only a session whose executors are threads of one process, as in tests, may leave it unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    own = spark.conf.get("spark.ledgerline.scratch", None)
    if not own:
        own = "file://" + tempfile.mkdtemp(prefix="ledgerline-")
        spark.conf.set("spark.ledgerline.scratch", own)
    return own


def written(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read back: lineage ends there, and lost executors cost no recomputation."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._folder = path
    if _open.get() is not None:
        _open.get().append(back)
    return back


def discarded(df: DataFrame) -> None:
    """Deletes the folder of a written table that nothing reads any more."""
    sc = df.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(df._folder)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch() -> Iterator[None]:
    """Tables written inside are deleted at its end, but those that leave it through kept."""
    outer = _open.set([])
    try:
        yield
    finally:
        own = _open.get()
        _open.reset(outer)
        for df in own:
            discarded(df)


def kept(df: DataFrame, name: str) -> DataFrame:
    """As written, for what a scratch leaves to those who read it after."""
    made = written(df, name)
    if _open.get() is not None:
        _open.get().remove(made)
    return made


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))
