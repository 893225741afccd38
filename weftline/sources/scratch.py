"""Scratch tables in the folder that the cluster names: they cut lineage, so a lost executor costs no recomputation."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


#: Files of a slim table, where there are fewer cores.
LEAST_FILES = 8


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir. Where it is unset, a temporary one in local mode (tests) and an error on a cluster."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="weftline-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    made = _MADE.get()
    if made is not None:
        made.append(path)
    return path


def written(df: DataFrame, name: str, slim: bool = False) -> DataFrame:
    """df as a written table, read back; cuts lineage and plan size. slim: rows of a few numbers, written by two tasks a
    core instead of one a partition, so that a small table isn't spread over as many files as the shuffle had parts."""
    path = scratch_path(df.sparkSession, name)
    (df.coalesce(max(LEAST_FILES, 2 * df.sparkSession.sparkContext.defaultParallelism)) if slim else df).write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


#: Paths that the innermost collected() gathers.
_MADE: ContextVar[list[str] | None] = ContextVar("_MADE", default=None)


@contextmanager
def collected() -> Iterator[list[str]]:
    """The paths of all scratch tables made within, for delete() once nothing reads them any more. What is left of them at
    the end is what an outer collected() gathers, too."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        outer = _MADE.get()
        if outer is not None:
            outer.extend(made)


def delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables that written() made, once all that reads them is itself written."""
    for t in tables:
        delete(t.sparkSession, [t.scratch_path])
