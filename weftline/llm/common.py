"""Shared pieces of the training-data operators: scratch tables and plain hashing."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.sources.scratch import collected, delete, discard, scratch_path as scratch, shared_dir, written  # noqa: F401

#: Words are runs of anything but these ASCII blanks (class body, valid in Java, RE2 and Python).
BLANKS = r"\x20\x09-\x0D"
WORD = rf"[^{BLANKS}]+"


def written_parts(df: DataFrame, name: str, by: str) -> tuple[DataFrame, str]:
    """written(), in a folder for each value of the column `by`, and its path: discard_part() deletes one of them."""
    path = scratch(df.sparkSession, name)
    df.write.partitionBy(by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard_part(spark: SparkSession, path: str, by: str, value: int) -> None:
    delete(spark, [f"{path}/{by}={value}"])


def hash_bits(docs: DataFrame, least: int, spread: int = 2) -> int:
    """Bits of the hash ranges that docs are dealt over: `spread` ranges a shuffle partition, and no range for more than
    RANGE_BYTES of the input, however large it is."""
    spark = docs.sparkSession
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    known = size // RANGE_BYTES if size < UNKNOWN_BYTES else 0
    return max(least, (spread * int(spark.conf.get("spark.sql.shuffle.partitions"))).bit_length(), int(known).bit_length())


#: Input bytes of a hash range; sizes from which Spark has no estimate of a plan.
RANGE_BYTES, UNKNOWN_BYTES = 256 << 20, 1 << 60


def by_size(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of consecutive rows of about `most` bytes in a string or binary column; a longer value is alone in its slice."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    a = done = 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield batch.slice(a, b - a)
        a, done = b, int(ends[b - 1])


def tidied(run):
    """run(batches), after which the worker's freed memory goes back to the system: workers are kept for other stages."""

    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            trim()

    return tidy


def trim() -> None:
    pa.default_memory_pool().release_unused()
    libc = _libc()
    if libc is not None:
        libc.malloc_trim(0)


@lru_cache
def _libc():
    try:
        libc = ctypes.CDLL("libc.so.6")
        return libc if hasattr(libc, "malloc_trim") else None
    except OSError:  # another system
        return None


def texts(df: DataFrame) -> DataFrame:
    """doc_id and text alone: other columns, whatever their names, never reach an operator."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def fold_of(doc_id: Column, k: int) -> Column:
    """crc32 of doc_id as text, mod k (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(k)


def fold_of_py(doc_id: int | None, k: int) -> int:
    """fold_of() for one id in Python."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % k


def lower_ascii(col: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: For bytes.translate / str.translate in Python workers.
LOWER_BYTES = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
LOWER_STR = {c: c + 32 for c in range(65, 91)}
