"""Token-ID output (8): ORC files of token ids in ascending doc_id order.

Stripes hold the ids with ORC's integer run-length encoding; row indexes and Bloom filters on doc_id let a
reader skip stripes and row groups from metadata, and the stripes of one file can be read in parallel.

Cases: a null text is an empty text (its row holds the end id alone); a null doc_id sorts first; rows that
repeat a doc_id are all kept, in order of their text; an empty table gives files without rows; other columns
of the input are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.llm.common import by_size, scratch, texts, written
from weftline.llm.tokens import CHUNK, default_path, encoder

#: Bytes of a stripe, rows of a row group.
STRIPE, ROWS = 16 << 20, 1000


def write_ids(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2) -> None:
    """Encode every text, append end_id and write (doc_id, row, ids) as ORC in ascending doc_id order.

    One range shuffle of the texts orders the files; the encoding runs after it, so no ids are shuffled.
    """
    tokenizer = tokenizer or default_path()

    def encode(batches):
        enc, row = encoder(tokenizer), 0
        for batch in batches:
            for part in by_size(batch, "text", CHUNK):
                ids, ends = enc.flat(part.column("text"))
                ids = np.insert(ids.astype(np.int32), ends[1:], end_id)
                ends = ends + np.arange(len(ends))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.arange(row, row + part.num_rows), pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))], names=["doc_id", "row", "ids"])
                row += part.num_rows

    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    (
        ordered.mapInArrow(encode, "doc_id long, row long, ids array<int>")
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.stripe.size", str(STRIPE))
        .option("orc.row.index.stride", str(ROWS))
        .option("orc.create.index", "true")
        .option("compression", "zstd")
        .orc(path)
    )


def read_ids(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Rows of the files; with doc_ids, the reader drops stripes and row groups by statistics and Bloom filter."""
    rows = spark.read.schema("doc_id long, row long, ids array<int>").orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(doc_ids))


def digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document as read back from the files: doc_id, start, n_tokens, ids_crc32.

    start is a prefix sum in two levels: over files (one row each), then over the rows within a file.
    """

    def sums(batches):
        for batch in batches:
            ids = batch.column("ids")
            flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            ends = ids.offsets.to_numpy()
            crcs = [zlib.crc32(flat[a:b].data) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("doc_id"), batch.column("row"), pa.array(np.diff(ends), pa.int64()), pa.array(crcs, pa.int64())], names=["file", "doc_id", "row", "n_tokens", "ids_crc32"])

    named = read_ids(spark, path).select(F.col("_metadata.file_name").alias("file"), "doc_id", "row", "ids")
    rows = written(named.mapInArrow(sums, "file string, doc_id long, row long, n_tokens long, ids_crc32 long"), "op8-sums")
    # files in the order of their tasks: by number, as names stop being ordered at 100,000 of them
    before = Window.orderBy("task", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("n")).withColumn("task", F.regexp_extract("file", r"^part-(\d+)", 1).cast("long"))
    files = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(files, "file").select("doc_id", (F.col("base") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).alias("start"), "n_tokens", "ids_crc32")


def op8_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "op8-ids")
    write_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return digest(spark, path)
