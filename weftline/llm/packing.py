"""Best-fit packing (3) by length-histogram planning.

The plan is made over counts of lengths, never over documents: best-fit decreasing fills sequences of equal
content together, so planning costs the same for a thousand documents and for a trillion. Documents then take
the planned slots by their rank within their length.

Cases: a null text is an empty text (one piece holding the end id); rows that repeat a doc_id are packed one by
one; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.llm.common import by_size, texts, written
from weftline.llm.tokens import CHUNK, default_path, encoder

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: A length's documents are ranked in so many groups at most, so that no length meets in one task.
SALTS = 256


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: all of them full but for the first."""
    first = n % most or most
    return [(0, first), *((a, most) for a in range(first, n, most))] if n > most else [(0, n)]


def pieces(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, most: int = 2048, with_ids: bool = False) -> DataFrame:
    """Encode every text, append end_id and cut what is longer than `most`; one row a piece, its ids if asked for."""
    tokenizer = tokenizer or default_path()

    def encode(batches):
        enc = encoder(tokenizer)
        for batch in batches:
            for part in by_size(batch, "text", CHUNK):
                out: list[tuple] = []
                kept: list[np.ndarray] = []
                for doc_id, found in zip(part.column("doc_id").to_pylist(), enc.ids_batch(part.column("text")), strict=True):
                    ids = np.append(found, np.uint32(end_id)).astype("<u4")
                    for k, (a, n) in enumerate(cut(len(ids), most)):
                        out.append((doc_id, k, a, n, zlib.crc32(ids[a : a + n].tobytes())))
                        kept += [ids[a : a + n]] if with_ids else []
                cols = list(zip(*out, strict=True)) or [()] * 5
                arrays = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
                yield pa.RecordBatch.from_arrays(arrays + ([pa.array([x.astype(np.int32) for x in kept], pa.list_(pa.int32()))] if with_ids else []), names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids])

    return texts(docs).mapInArrow(encode, PIECE + ", ids array<int>" * with_ids)


def plan(counts: dict[int, int], most: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first rank, ranks, first sequence, offset).

    Sequences with the same content are a range of ids. Best fit puts a length into the fullest sequence that
    still has room, again and again, so a sequence with room r takes r // length of them before the next one.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    out, made = [], 0

    def keep(r: int, first: int, n: int) -> None:
        if r and n:
            if r not in room:
                room[r] = []
                bisect.insort(rooms, r)
            room[r].append((first, n))

    for length in sorted((x for x in counts if x > 0), reverse=True):
        left, rank = counts[length], 0
        while left:
            k = bisect.bisect_left(rooms, length)
            if k < len(rooms):
                r = rooms[k]
                first, n = room[r].pop()
                if not room[r]:
                    del room[r]
                    rooms.pop(k)
            else:
                r, first, n = most, made, -(-left // (most // length))
                made += n
            each = min(r // length, left)
            full = min(n, left // each)
            for j in range(each):
                out.append((length, rank, full, first, most - r + j * length))
                rank += full
            left -= full * each
            keep(r - each * length, first, full)
            first, n = first + full, n - full
            if left and n and left < each:
                for j in range(left):
                    out.append((length, rank, 1, first, most - r + j * length))
                    rank += 1
                keep(r - left * length, first, 1)
                first, n, left = first + 1, n - 1, 0
            keep(r, first, n)
    return out


def place(rows: DataFrame, most: int = 2048) -> DataFrame:
    """rows (a written table with doc_id, piece, length and more) with sequence_id and offset.

    Ranks within a length are a prefix sum over salted counts plus a row number within the salt. The plan has
    a few entries for each of the at most `most` lengths, whatever the number of rows.
    """
    slots = plan({r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}, most)
    table = np.array(sorted((a, b, c, d, e) for a, b, c, d, e in slots), np.int64).reshape(-1, 5)
    shared = rows.sparkSession.sparkContext.broadcast(table)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = salted.join(bases, ["length", "salt"]).withColumn("rank", F.col("base") + F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start")) - 1)

    names = rows.columns

    def take(batches):
        t = shared.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            # ranks stay below 2**50 and lengths below 2**13: one sorted key for both
            at = np.searchsorted((t[:, 0] << 50) + t[:, 1], (length << 50) + rank, side="right") - 1 if len(t) else np.zeros(0, int)
            found = t[at] if len(t) else np.zeros((0, 5), np.int64)
            seq = found[:, 3] + rank - found[:, 1]
            keep = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(seq, pa.int64()), pa.array(found[:, 4], pa.int64())], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return ranked.select(*names, "rank").mapInArrow(take, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, most: int = 2048, with_ids: bool = False) -> DataFrame:
    """Pieces with their places; with_ids carries the ids as well, for sequences()."""
    return place(written(pieces(docs, tokenizer, end_id, most, with_ids), "op3-pieces"), most)


def sequences(packed: DataFrame) -> DataFrame:
    """One row a sequence: its ids in order and the pieces they come from. A sequence is bounded, so is each group."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("offsets"))


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
