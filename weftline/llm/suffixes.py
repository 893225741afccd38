"""Suffix-array dedup (6) with a logarithmic index family.

Every byte that a 200-byte string covers which also starts elsewhere goes. Suffixes are sampled by content: each
200-byte window is represented by the smallest of the hashes of its 32-byte strings (its leftmost place), so
equal windows choose equal places. A suffix array holds the sampled suffixes of a batch in the byte order of
their heads (the 32 bytes that any match of them shares), each with a fingerprint of the region of all windows
that the sample represents.

- A batch's arrays are dealt over ranges of the heads' hashes. Within a range the new batch's array is
  merge-scanned against the stored level arrays: only what shares a head with the batch is looked at. Level
  arrays of as many batches as the new one merge with it, so n batches leave log(n) levels, and all other
  levels stay as they are stored (class Family).
- A suffix whose region occurs twice has only repeated windows. One that shares its head with other regions alone is
  compared with them: the regions of a head meet, and each of their windows decides. Regions of a head that more
  than HOT of them share send hashes of their windows instead, dealt by these hashes and counted before they are
  sent, so that what very many suffixes share meets as a row a task.
- Documents get their ranges back (by two hashes of doc_id and text: rows that are equal have equal ranges), and
  every range of starts [a, b] removes bytes a .. b + 199.

Matches are judged on the input and never cross documents. Texts that repeat cost a row a task, as equal
regions are counted before the shuffle. Heads are compared byte by byte, regions and windows by 64-bit hashes.

Cases: a null text is empty; texts under 200 bytes keep all; a null doc_id takes part like any other; repeated
rows repeat each other's text, so texts of 200 bytes and more lose all of it; an empty table gives no rows;
other columns are ignored; a very long text is hashed in overlapping slices.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import bytehash
from weftline.llm.common import delete, discard_part, hash_bits, texts, tidied, written, written_parts

LENGTH, GRAM = 200, 32
#: Bytes hashed at once, suffixes that a task packs at once, windows that it packs at once.
BLOCK, PACKED, SENT = 1 << 19, 1 << 19, 1 << 20
POSITION = 22  # bits
U = np.uint64

ENTRY = np.dtype([("head", f"S{GRAM}"), ("region", "<u8"), ("part", "<i8"), ("rec", "<u4"), ("many", "u1")])
STATUS = np.dtype([("rec", "<u4"), ("status", "u1")])
#: All windows of the region occur elsewhere; the region's windows are to be compared; by their hashes.
REPEATED, WANTED, SHARED = 1, 2, 4
#: Regions of a head from which windows are dealt by hash; bytes of regions that a task packs at once.
HOT, BYTES = 1024, 1 << 24
KEYS = ("key", "key2")


def keyed(docs: DataFrame) -> DataFrame:
    """docs with two 64-bit hashes that tell its rows apart by doc_id and text."""
    return docs.withColumns({"key": F.xxhash64("doc_id", "text"), "key2": F.xxhash64("text", "doc_id", F.lit(GRAM))})


def sampled(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Of texts laid end to end: first and last start, place, hash of the head, head and region of each sampled suffix."""
    none = np.zeros(0, np.int64)
    nothing = none, none, none, none.astype(np.uint64), none.astype(f"S{GRAM}"), none.astype(np.uint64)
    if len(data) < length:
        return nothing
    p = bytehash.prefix(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = bytehash.substrings(p, at, at + GRAM)
    mask = U((1 << POSITION) - 1)
    low = (grams & ~mask) | at.astype(np.uint64)
    span, width = length - GRAM + 1, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
    starts = np.arange(len(low))
    room = np.repeat(offsets[1:], np.diff(offsets))[: len(low)] - starts >= length
    starts, place = starts[room], (low[room] & mask).astype(np.int64)
    if not len(starts):
        return nothing
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    first, last, place = starts[new], starts[np.append(new[1:] - 1, len(starts) - 1)], place[new]
    region = bytehash.substrings(p, first, last + length) + (place - first).astype(np.uint64) * U(0x9FB21C651E98DF25)
    head = np.lib.stride_tricks.sliding_window_view(data, GRAM)[place].view(f"S{GRAM}").ravel()
    # the chosen hashes are small ones: mixed anew, they spread over all hash ranges
    return first, last, place, bytehash.mix(grams[place] * U(0x9E3779B97F4A7C15)), head, bytehash.mix(region)


def slices(data: np.ndarray, length: int, block: int):
    """(shift, bytes) of a long text, overlapping so that each window lies in exactly one."""
    for a in range(0, max(1, len(data) - length + 1), block):
        yield a, data[a : a + block + length - 1]


def _squeezed(*arrays: np.ndarray) -> bytes:
    raw = b"".join(x.tobytes() for x in arrays)
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def _unsqueezed(blob: bytes) -> bytes:
    n = int.from_bytes(blob[:8], "little")
    return pa.decompress(blob[8:], n, codec="zstd", asbytes=True) if n else b""


def _columns(raw: bytes, *kinds: str) -> list[np.ndarray]:
    """Columns of equal length laid one after the other."""
    n, at, out = len(raw) // sum(np.dtype(k).itemsize for k in kinds), 0, []
    for k in kinds:
        out.append(np.frombuffer(raw, k, n, at))
        at += n * np.dtype(k).itemsize
    return out


def stored(run: np.ndarray) -> bytes:
    return _squeezed(*(run[c] for c in ENTRY.names))


def loaded(blob: bytes) -> np.ndarray:
    cols = _columns(_unsqueezed(blob), *(ENTRY[c].str for c in ENTRY.names))
    out = np.zeros(len(cols[0]), ENTRY)
    for c, x in zip(ENTRY.names, cols, strict=True):
        out[c] = x
    return out


def merge(runs: list[np.ndarray]) -> np.ndarray:
    """Suffix arrays as one, in byte order of the heads; a stable sort by runs merges them in linear time."""
    both = np.concatenate(runs)
    return both[np.argsort(both["head"], kind="stable")]


def by_region(run: np.ndarray) -> np.ndarray:
    """A suffix array with equal heads ordered by region."""
    if not len(run):
        return run
    group = np.cumsum(np.concatenate([[True], run["head"][1:] != run["head"][:-1]])) - 1
    at = np.flatnonzero(np.bincount(group)[group] > 1)
    run[at] = run[at[np.lexsort((run["region"][at], group[at]))]]
    return run


def statuses(run: np.ndarray) -> np.ndarray:
    """Status of each entry of a suffix array that holds all entries of its heads."""
    if not len(run):
        return np.zeros(0, np.uint8)
    new_head = np.concatenate([[True], run["head"][1:] != run["head"][:-1]])
    new_region = new_head | np.concatenate([[True], run["region"][1:] != run["region"][:-1]])
    group, kind = np.cumsum(new_head) - 1, np.cumsum(new_region) - 1
    single = np.bincount(kind, 1 + (run["many"] > 0))[kind] < 2
    kinds = np.bincount(group[new_region])[group]
    wanted = (kinds > 1) & (np.bincount(group, single)[group] > 0) & new_region
    return np.where(single, 0, REPEATED).astype(np.uint8) | np.where(wanted, np.where(kinds > HOT, WANTED | SHARED, WANTED), 0).astype(np.uint8)


def scan(new: np.ndarray, levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Merge-scan of a batch's array against each level: entries with a status, and these. Of the levels only the
    entries that share a head with the batch are looked at."""
    heads = new["head"][np.concatenate([[True], new["head"][1:] != new["head"][:-1]])] if len(new) else new["head"]
    met = [new]
    for level in levels:
        lo, hi = np.searchsorted(level["head"], heads, "left"), np.searchsorted(level["head"], heads, "right")
        n = hi - lo
        met.append(level[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum()))])
    both = by_region(merge(met))
    status = statuses(both)
    return both[status > 0], status[status > 0]


def suffix_arrays(docs: DataFrame, bits: int, batch: int = 0, length: int = LENGTH) -> DataFrame:
    """Rows (own, to, part, blob): a batch's sampled suffixes by hash range (own 0), and what each part has (own 1)."""

    def run(batches):
        task, made, held = TaskContext.get().partitionId(), 0, 0
        rows_: list[tuple] = []
        got: list[tuple] = []

        def flush():
            nonlocal made
            part = batch << 44 | task << 20 | made
            made += 1
            doc, first, last, place, token, head, region = (np.concatenate(x) for x in zip(*got, strict=True)) if got else (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64), np.zeros(0, f"S{GRAM}"), np.zeros(0, np.uint64))
            to = (token >> U(64 - bits)).astype(np.int64)
            order = np.lexsort((region, head, to))
            same = np.concatenate([[False], (head[order][1:] == head[order][:-1]) & (region[order][1:] == region[order][:-1])]) if len(order) else np.zeros(0, bool)
            heads = order[~same]  # the first occurrence of each
            leader = np.empty(len(order), np.int64)
            leader[order] = heads[np.cumsum(~same) - 1] if len(order) else 0
            uniq, rec = np.unique(leader, return_inverse=True)  # numbered by first occurrence
            entry = np.zeros(len(heads), ENTRY)
            entry["head"], entry["region"], entry["part"], entry["rec"] = head[heads], region[heads], part, np.searchsorted(uniq, heads)
            entry["many"] = np.bincount(rec, minlength=len(uniq))[entry["rec"]] > 1
            to = to[heads]
            cut = np.flatnonzero(np.diff(to, prepend=-1))
            blobs = [stored(x) for x in np.split(entry, cut[1:])] if len(cut) else []
            cols = list(zip(*rows_, strict=True)) or [()] * 5
            own = pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["doc_id", *KEYS, "n_bytes", "sha"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, own.schema) as w:
                w.write_table(own)
            where = _squeezed(*(np.diff(x, prepend=0).astype("<i4") for x in (rec, doc, first)), (last - first).astype("<i4"), (place - first).astype("<i4"))
            rows = [(1, -1, sink.getvalue().to_pybytes()), (1, -2, where), *((0, int(t), b) for t, b in zip(to[cut].tolist(), blobs, strict=True))]
            rows_.clear()
            got.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows], pa.int32()), pa.array([part] * len(rows), pa.int64()), pa.array([r[2] for r in rows], pa.binary()), pa.array([r[0] for r in rows], pa.int32())], names=["to", "part", "blob", "own"])

        for rows in batches:
            doc_ids, keys, keys2 = (rows.column(c).to_pylist() for c in ("doc_id", *KEYS))
            for at, data, offsets in bytehash.blocks(rows.column("text"), BLOCK):
                base = len(rows_)
                for j, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    rows_.append((doc_ids[at + j], keys[at + j], keys2[at + j], b - a, hashlib.sha256(data[a:b]).digest()))
                if len(data) > 2 * BLOCK:  # one long text
                    for shift, piece in slices(data, length, BLOCK):
                        first, last, place, *found = sampled(piece, np.array([0, len(piece)]), length)
                        got.append((np.full(len(first), base), first + shift, last + shift, place + shift, *found))
                        held += len(first)
                else:
                    first, last, place, *found = sampled(data, offsets, length)
                    doc = np.searchsorted(offsets, first, side="right") - 1
                    got.append((base + doc, first - offsets[doc], last - offsets[doc], place - offsets[doc], *found))
                    held += len(first)
                if held >= PACKED or len(rows_) >= 1 << 20:
                    yield flush()
                    held = 0
        if rows_:
            yield flush()

    return keyed(texts(docs)).mapInArrow(tidied(run), "to int, part long, blob binary, own int")


def level_rows(new: DataFrame, levels: list[DataFrame], merging: int, keep: bool) -> DataFrame:
    """Rows (kind, id, blob): statuses that a batch's scan against the levels gives (kind 1, by part) and, if another
    batch is to follow, the batch's array merged with the last `merging` levels (kind 0, by hash range)."""
    rows = new.select("to", F.lit(-1).alias("level"), "blob")
    for k, level in enumerate(levels):
        rows = rows.unionByName(level.select(F.col("id").cast("int").alias("to"), F.lit(k).alias("level"), "blob"))

    first = len(levels) - merging

    def run(key, table):
        of: dict[int, list[np.ndarray]] = {}
        for k, blob in zip(table.column("level").to_pylist(), table.column("blob").to_pylist(), strict=True):
            of.setdefault(k, []).append(loaded(blob))
        own = merge(of.pop(-1, [np.zeros(0, ENTRY)]))
        old = {k: x for k, (x,) in of.items()}  # a level has one array in a range
        said, status = scan(own, list(old.values()))
        out = np.zeros(len(said), STATUS)
        out["rec"], out["status"] = said["rec"], status
        order = np.argsort(said["part"], kind="stable")
        out, owner = out[order], said["part"][order]
        cut = np.flatnonzero(np.diff(owner, prepend=-1))
        rows = [(1, int(p), _squeezed(x)) for p, x in zip(owner[cut].tolist(), np.split(out, cut[1:]) if len(cut) else [], strict=True)]
        if keep:
            rows.append((0, key[0].as_py(), stored(merge([*(x for k, x in old.items() if k >= first), own]))))
        return pa.table([pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary()), pa.array([r[0] for r in rows], pa.int32())], names=["id", "blob", "kind"])

    return rows.groupBy("to").applyInArrow(run, "id long, blob binary, kind int")


def touched(own: DataFrame, said: DataFrame) -> DataFrame:
    """A row for each document: doc_id, keys, n_bytes, sha and, if any of it may repeat, its repeated ranges of
    starts and the regions to compare (first, last, place, status)."""
    rows = own.select("part", "to", "blob").unionByName(said.select(F.col("id").alias("part"), F.lit(0).alias("to"), "blob"))

    def run(table):
        to, blobs = table.column("to").to_pylist(), table.column("blob").to_pylist()
        docs = pa.ipc.open_stream(next(b for b, t in zip(blobs, to, strict=True) if t == -1)).read_all()
        cols = [x.astype(np.int64) for x in _columns(_unsqueezed(next(b for b, t in zip(blobs, to, strict=True) if t == -2)), *["<i4"] * 5)]
        rec, doc, first = (np.cumsum(c) for c in cols[:3])
        last, place = first + cols[3], first + cols[4]
        status = np.zeros(int(rec.max()) + 1 if len(rec) else 0, np.uint8)
        for b, t in zip(blobs, to, strict=True):
            if t == 0:
                s = np.frombuffer(_unsqueezed(b), STATUS)
                status[s["rec"]] |= s["status"]
        mine = status[rec] if len(rec) else np.zeros(0, np.uint8)
        repeated = np.flatnonzero(mine & REPEATED)
        want = np.flatnonzero(mine & WANTED)
        want = np.sort(want[np.unique(rec[want], return_index=True)[1]]) if len(want) else want  # one occurrence will do
        size = docs.num_rows
        cut_r, cut_w = np.searchsorted(doc[repeated], np.arange(size + 1)), np.searchsorted(doc[want], np.arange(size + 1))
        ranges = np.stack([first[repeated], last[repeated]], axis=1)
        asks = np.stack([first[want], last[want], place[want], mine[want].astype(np.int64)], axis=1) if len(want) else np.zeros((0, 4), np.int64)
        got = [(ranges[a:b].tobytes(), asks[c:d].tobytes()) if b > a or d > c else (None, None) for a, b, c, d in zip(cut_r[:-1].tolist(), cut_r[1:].tolist(), cut_w[:-1].tolist(), cut_w[1:].tolist(), strict=True)]
        names = ["doc_id", *KEYS, "n_bytes", "sha"]
        return pa.table([*(docs.column(c) for c in names), pa.array([x for x, _ in got], pa.binary()), pa.array([x for _, x in got], pa.binary())], names=[*names, "ranges", "asks"])

    return rows.groupBy("part").applyInArrow(run, "doc_id long, key long, key2 long, n_bytes long, sha binary, ranges binary, asks binary")


def windows(found: DataFrame, bits: int, length: int) -> DataFrame:
    """Rows (to, part, blob): hashes of the windows of all regions of HOT heads, by hash range (to >= 0), and which
    windows a part has (to < 0)."""

    def run(batches):
        task, made, size = TaskContext.get().partitionId(), 0, 0
        asked: list[tuple] = []
        held: list[np.ndarray] = []

        def flush():
            nonlocal made
            part = task << 20 | made
            made += 1
            words, rec, n = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
            to = (words >> U(64 - bits)).astype(np.int64)
            cut = np.flatnonzero(np.diff(to, prepend=-1))
            rows = [(-1, _squeezed(np.array(asked, "<i8"))), (-2, _squeezed(rec.astype("<u4")))]
            rows += [(int(to[a]), _squeezed(words[a:b], np.arange(a, b, dtype="<u4"), (n[a:b] > 1).astype("u1"))) for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(words)], strict=True)]
            asked.clear()
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([part] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["to", "part", "blob"])

        for batch in batches:
            for key, key2, text, asks in zip(*(batch.column(c).to_pylist() for c in (*KEYS, "text", "asks")), strict=True):
                raw = np.frombuffer((text or "").encode(), np.uint8)
                for first, last, _, status in np.frombuffer(asks, "<i8").reshape(-1, 4).tolist():
                    if status & SHARED:
                        at = np.arange(last - first + 1)
                        held.append(bytehash.substrings(bytehash.prefix(raw[first : last + length]), at, at + length))
                        asked.append((key, key2, first, len(at), status & REPEATED))
                        size += len(at)
                if size >= SENT:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return found.select(*KEYS, "text", "asks").mapInArrow(tidied(run), "to int, part long, blob binary")


def compared(sent: DataFrame) -> DataFrame:
    """(key, key2, ranges): the ranges of starts, among the windows sent, whose windows occur more than once."""

    def count(table):
        parts, blobs = table.column("part").to_pylist(), [_columns(_unsqueezed(b), "<u8", "<u4", "u1") for b in table.column("blob").to_pylist()]
        words, at = np.unique(np.concatenate([b[0] for b in blobs]), return_inverse=True)
        often = (np.bincount(at, np.concatenate([b[2] for b in blobs]) + 1.0, len(words)) > 1)[at]
        cut = np.cumsum([0, *(len(b[0]) for b in blobs)])
        return pa.table({"part": pa.array(parts, pa.int64()), "to": pa.array([0] * len(parts), pa.int32()), "blob": pa.array([_squeezed(b[1][often[a:e]]) for b, a, e in zip(blobs, cut[:-1].tolist(), cut[1:].tolist(), strict=True)], pa.binary())})

    def gather(table):
        to, blobs = table.column("to").to_pylist(), [_unsqueezed(b) for b in table.column("blob").to_pylist()]
        asked = np.frombuffer(blobs[to.index(-1)], "<i8").reshape(-1, 5)
        rec = np.frombuffer(blobs[to.index(-2)], "<u4")
        often = np.zeros(int(rec.max()) + 1, bool)
        for b, t in zip(blobs, to, strict=True):
            if t == 0:
                often[np.frombuffer(b, "<u4")] = True
        of = np.repeat(np.arange(len(asked)), asked[:, 3])
        start = np.arange(len(of)) - np.repeat(np.cumsum(asked[:, 3]) - asked[:, 3], asked[:, 3]) + asked[of, 2]
        dup = np.flatnonzero(often[rec] & (asked[of, 4] == 0))
        return _ranges(asked[of[dup], :2], start[dup])

    counts = sent.where("to >= 0").groupBy("to").applyInArrow(lambda t: count(t), "part long, to int, blob binary")
    return sent.where("to < 0").select("part", "to", "blob").unionByName(counts).groupBy("part").applyInArrow(lambda t: gather(t), "key long, key2 long, ranges binary")


def regions(found: DataFrame, bits: int, length: int) -> DataFrame:
    """Rows (to, blob): the bytes of all other regions asked for, packed by a hash range of their heads."""

    def packed(rows: list[tuple]) -> bytes:
        return len(rows).to_bytes(8, "little") + _squeezed(np.array([(*r[:4], len(r[4])) for r in rows], "<i8"), np.frombuffer(b"".join(r[4] for r in rows), np.uint8))

    def run(batches):
        held: dict[int, list[tuple]] = {}
        size = 0

        def flush():
            tos = sorted(held)
            out = pa.RecordBatch.from_arrays([pa.array(tos, pa.int64()), pa.array([packed(held[t]) for t in tos], pa.binary())], names=["to", "blob"])
            held.clear()
            return out

        for batch in batches:
            for key, key2, text, asks in zip(*(batch.column(c).to_pylist() for c in (*KEYS, "text", "asks")), strict=True):
                raw = (text or "").encode()
                for first, last, place, status in np.frombuffer(asks, "<i8").reshape(-1, 4).tolist():
                    if not status & SHARED:
                        to = int.from_bytes(hashlib.blake2b(raw[place : place + GRAM], digest_size=8).digest(), "little") >> (64 - bits)
                        held.setdefault(to, []).append((key, key2, first, status & REPEATED, raw[first : last + length]))
                        size += last + length - first
                if size >= BYTES:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return found.select(*KEYS, "text", "asks").mapInArrow(tidied(run), "to long, blob binary")


def met(sent: DataFrame, length: int) -> DataFrame:
    """(key, key2, ranges): the ranges of starts, among the regions sent, whose windows occur more than once."""

    def run(table):
        heads, bodies = [], []
        for blob in table.column("blob").to_pylist():
            n, raw = int.from_bytes(blob[:8], "little"), _unsqueezed(blob[8:])
            heads.append(np.frombuffer(raw, "<i8", 5 * n).reshape(n, 5))
            bodies.append(np.frombuffer(raw, np.uint8, offset=40 * n))
        head = np.concatenate(heads)
        ends = np.concatenate([[0], np.cumsum(head[:, 4])])
        data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(head), [None, pa.py_buffer(ends), pa.py_buffer(np.concatenate(bodies))])
        hashes, where, start = [], [], []
        for at, block, offsets in bytehash.blocks(data, BLOCK):
            n = np.diff(offsets) - length + 1
            row = np.repeat(np.arange(len(n)), n)
            s = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            hashes.append(bytehash.substrings(bytehash.prefix(block), offsets[row] + s, offsets[row] + s + length))
            where.append((row + at).astype(np.int32))
            start.append(s.astype(np.int32))
        h, of, start = (np.concatenate(x) for x in (hashes, where, start))
        order = np.argsort(h, kind="stable")
        same = h[order][1:] == h[order][:-1]
        dup = np.zeros(len(h), bool)
        dup[order] = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        dup &= head[of, 3] == 0
        return _ranges(head[of[dup], :2], head[of[dup], 2] + start[dup])

    return sent.groupBy("to").applyInArrow(run, "key long, key2 long, ranges binary")


def _ranges(owner: np.ndarray, start: np.ndarray) -> pa.Table:
    """(key, key2, ranges) of starts; those of a region ascend and follow each other."""
    if not len(start):
        return pa.table({"key": pa.array([], pa.int64()), "key2": pa.array([], pa.int64()), "ranges": pa.array([], pa.binary())})
    other = (owner[1:] != owner[:-1]).any(axis=1)
    new = np.flatnonzero(np.concatenate([[True], other | (start[1:] != start[:-1] + 1)]))
    pairs = np.stack([start[new], start[np.append(new[1:] - 1, len(start) - 1)]], axis=1).astype("<i8")
    owner = owner[new]
    cut = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]).any(axis=1)]))
    return pa.table({"key": pa.array(owner[cut, 0], pa.int64()), "key2": pa.array(owner[cut, 1], pa.int64()), "ranges": pa.array([x.tobytes() for x in np.split(pairs, cut[1:])], pa.binary())})


def removed_spans(ranges: list[bytes], length: int) -> np.ndarray:
    """Maximal spans [a, b) covered by the windows of all ranges of starts."""
    r = np.concatenate([np.frombuffer(x, "<i8").reshape(-1, 2) for x in ranges])
    r = r[np.argsort(r[:, 0], kind="stable")]
    ends = np.maximum.accumulate(r[:, 1] + length)
    new = np.concatenate([[True], r[1:, 0] > ends[:-1]])
    at = np.flatnonzero(new)
    return np.stack([r[at, 0], ends[np.append(at[1:] - 1, len(r) - 1)]], axis=1)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


class Family:
    """The index family: add() batches of documents, then cut() what repeats in all of them together.

    Levels are written tables of (id, blob), a suffix array for each hash range; `sizes` tells how many batches each
    level holds. A new batch merges with the last levels as long as they hold as many as it has by then.
    """

    def __init__(self, spark: SparkSession, length: int = LENGTH, bits: int | None = None):
        self.spark, self.length, self.bits = spark, length, bits
        self.batches, self.ended = 0, False
        self.docs: DataFrame | None = None
        self.own: list[DataFrame] = []
        self.said: list[DataFrame] = []
        self.levels: list[tuple[DataFrame, str]] = []
        self.sizes: list[int] = []
        self.paths: list[str] = []

    def add(self, docs: DataFrame, last: bool = False) -> None:
        """A new batch; after the last one no level is written, so none can follow."""
        if self.ended:
            raise ValueError("the last batch was added")
        self.bits = self.bits or hash_bits(docs, 8)
        made, path = written_parts(suffix_arrays(docs, self.bits, self.batches, self.length), "op6-suffixes", "own")
        self.own.append(made.where("own = 1"))
        self.paths.append(path)
        size, merging = 1, 0
        while merging < len(self.sizes) and self.sizes[-1 - merging] == size:
            size, merging = 2 * size, merging + 1
        found, level = written_parts(level_rows(made.where("own = 0"), [d for d, _ in self.levels], merging, not last), "op6-levels", "kind")
        self.said.append(found.where("kind = 1"))
        self.paths.append(level)
        discard_part(self.spark, path, "own", 0)  # the level has them
        gone = self.levels if last else self.levels[len(self.levels) - merging :]
        for _, old in gone:
            discard_part(self.spark, old, "kind", 0)
        self.levels = [] if last else [*self.levels[: len(self.levels) - merging], (found.where("kind = 0"), level)]
        self.sizes = [] if last else [*self.sizes[: len(self.sizes) - merging], size]
        self.docs = texts(docs) if self.docs is None else self.docs.unionByName(texts(docs))
        self.batches, self.ended = self.batches + 1, last

    def cut(self, with_text: bool = False) -> DataFrame:
        """Per row of the documents: doc_id, n_bytes, n_removed, n_spans, kept_sha256. With text: key, key2 (see keyed())
        and kept text of the rows that lose bytes; what remains of a character cut in two goes too."""
        length = self.length
        every = written(touched(reduce(DataFrame.unionByName, self.own), reduce(DataFrame.unionByName, self.said)), "op6-documents")
        if self.ended:  # no batch can follow
            delete(self.spark, self.paths)
            self.paths = []
        # equal rows have equal ranges: one of them is joined, with each of the rows
        work = every.where("ranges IS NOT NULL").groupBy(*KEYS).agg(F.first("ranges").alias("ranges"), F.first("asks").alias("asks"))
        found = written(keyed(self.docs).join(work, [*KEYS]).select(*KEYS, "doc_id", "text", "ranges", "asks"), "op6-found")
        asked = found.where(F.length("asks") > 0)
        sent = written(windows(asked, self.bits, length), "op6-windows")
        more = compared(sent).unionByName(met(regions(asked, self.bits, length), length)).groupBy(*KEYS).agg(F.collect_list("ranges").alias("more"))  # of one text
        joined = found.join(more, [*KEYS], "left").select(*KEYS, "doc_id", "text", "ranges", "more")

        def finish(batches):
            for batch in batches:
                out = []
                for doc_id, key, key2, text, own, others in zip(*(batch.column(c).to_pylist() for c in ("doc_id", *KEYS, "text", "ranges", "more")), strict=True):
                    raw = (text or "").encode()
                    given = [x for x in (own, *(others or ())) if x]
                    spans = removed_spans(given, length).tolist() if given else []
                    kept, at = [], 0
                    for a, b in spans:
                        kept.append(raw[at:a])
                        at = b
                    kept = b"".join([*kept, raw[at:]])
                    out.append((doc_id, len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), key, key2, kept.decode("utf-8", "ignore") if with_text and spans else None))
                cols = list(zip(*out, strict=True)) or [()] * 8
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *KEYS, "kept"])

        cut = joined.mapInArrow(tidied(finish), RESULT + ", key long, key2 long, kept string")
        if with_text:
            return cut.where("n_spans > 0").select(*KEYS, "kept").dropDuplicates([*KEYS])
        zero = F.lit(0).cast("long")
        rest = every.where("ranges IS NULL").select("doc_id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.lower(F.hex("sha")).alias("kept_sha256"))
        return cut.select(*rest.columns).unionByName(rest)


#: Batches that the query adds one after the other: together they are all documents.
BATCHES = 4


def op6_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    family = Family(spark, bits=hash_bits(docs, 8))
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(BATCHES))
    for k in range(BATCHES):
        family.add(docs.where(batch == k), last=k == BATCHES - 1)
    return family.cut()
