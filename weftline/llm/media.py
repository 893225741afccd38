"""Media columns (4): audio stored losslessly, and features of it as fixed-shape Arrow tensors with time spans.

to_audio() makes 8-bit mono PCM in a RIFF/WAVE column, with JVM functions alone, and stored() writes it as a table in the
shared folder. audio_features() reads the stored bytes back: rational polyphase resampling, overlapped log-mel
filterbanks and hysteresis segmentation of the frame energy. Its tensors can be stored as they are (store_features());
described() reads them where they are made, so that a digest of them costs no second trip through the JVM.
Everything is row by row, so no key or source can make a task large; very long payloads are worked on in blocks of
frames. A payload and its header have to fit a binary value (2 GB), as the text has to fit a string.

Cases: a null text is an empty text; an empty text is stored as 64 zero bytes; equal texts give equal values;
repeated rows give repeated rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import scratch, texts, tidied

UNIT, HEADER = 64, 44


@dataclass(frozen=True)
class Audio:
    """Parameters of the features; times are in samples of the resampled signal unless they end in _db."""

    rate: int = 8000
    up: int = 2
    down: int = 5
    taps: int = 8  # of each phase
    window: int = 256
    hop: int = 128
    mels: int = 24
    tile: int = 16  # frames of a tensor
    on_db: float = -12.0  # below the loudest frame
    off_db: float = -18.0
    block: int = 4096  # frames worked on at once

    @property
    def out_rate(self) -> float:
        return self.rate * self.up / self.down


def _le32(n: Column) -> Column:
    """A 32-bit number as four little-endian bytes."""
    h = F.lpad(F.hex(n), 8, "0")
    return F.unhex(F.concat(*(F.substring(h, k, 2) for k in (7, 5, 3, 1))))


def to_audio(docs: DataFrame, rate: int = 8000) -> DataFrame:
    """doc_id, n_bytes, media: the text's UTF-8 bytes, zero-padded to a positive multiple of 64, as WAVE samples."""
    raw = texts(docs).select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("raw"))
    sized = raw.withColumn("n_bytes", F.length("raw").cast("long")).withColumn("n", F.greatest(F.lit(1), F.ceil(F.col("n_bytes") / UNIT)) * UNIT)
    payload = F.expr("rpad(raw, cast(n as int), X'00')")
    fmt = struct.pack("<IHHIIHH", 16, 1, 1, rate, rate, 1, 8)
    media = F.concat(F.lit(b"RIFF"), _le32(F.col("n") + HEADER - 8), F.lit(b"WAVEfmt " + fmt + b"data"), _le32(F.col("n")), payload)
    return sized.select("doc_id", "n_bytes", media.alias("media"))


def samples(media: bytes) -> tuple[int, memoryview]:
    """Rate and payload of a stored WAVE file."""
    if media[:4] != b"RIFF" or media[8:16] != b"WAVEfmt " or media[36:40] != b"data" or struct.unpack_from("<H", media, 34)[0] != 8:
        raise ValueError("not a stored 8-bit WAVE")
    n = struct.unpack_from("<I", media, 40)[0]
    return struct.unpack_from("<I", media, 24)[0], memoryview(media)[HEADER : HEADER + n]


@lru_cache
def _filters(p: Audio) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Low-pass taps by phase, the window, the mel matrix (bins x mels)."""
    n = p.taps * p.up
    t = np.arange(n) - (n - 1) / 2
    cut = 0.5 / max(p.up, p.down)
    h = 2 * cut * np.sinc(2 * cut * t) * np.hamming(n)
    h *= p.up / h.sum()
    phases = np.stack([h[k :: p.up] for k in range(p.up)]).astype(np.float32)
    bins = np.arange(p.window // 2 + 1) * p.out_rate / p.window
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = np.linspace(0, mel(p.out_rate / 2), p.mels + 2)
    rise, fall = (mel(bins)[:, None] - edges[:-2]) / np.diff(edges)[:-1], (edges[2:] - mel(bins)[:, None]) / np.diff(edges)[1:]
    return phases, np.hanning(p.window).astype(np.float32), np.maximum(0, np.minimum(rise, fall)).astype(np.float32)


def resampled_length(n: int, p: Audio) -> int:
    return -(-n * p.up // p.down)


def resample(x: np.ndarray, first: int, count: int, p: Audio) -> np.ndarray:
    """Samples [first, first + count) of the polyphase-resampled x (8-bit unsigned); outside of x is silence.

    Output n takes input around n * down / up through the taps of phase (n * down) mod up. `first` has to be
    a multiple of up.
    """
    phases, _, _ = _filters(p)
    half, periods = p.taps // 2, -(-count // p.up)
    base = first // p.up * p.down
    need = periods * p.down + p.taps + p.down
    lo = base - half
    part = np.zeros(need, np.float32)
    a, b = max(lo, 0), min(lo + need, len(x))
    if b > a:
        part[a - lo : b - lo] = (x[a:b].astype(np.float32) - 128) / 128
    y = np.empty((periods, p.up), np.float32)
    for r in range(p.up):
        at, phase = divmod(r * p.down, p.up)
        taps = phases[phase]
        y[:, r] = sum(taps[p.taps - 1 - k] * part[at + k : at + k + periods * p.down : p.down] for k in range(p.taps))
    return y.ravel()[:count]


def log_mel(payload, p: Audio) -> tuple[np.ndarray, np.ndarray]:
    """Log-mel frames (frames x mels) in dB and frame energy in dB; the last frame is padded with silence."""
    x = np.frombuffer(payload, np.uint8)
    n = resampled_length(len(x), p)
    frames = max(1, -(-max(0, n - p.window) // p.hop) + 1)
    _, window, mel = _filters(p)
    mels, energy = np.empty((frames, p.mels), np.float32), np.empty(frames, np.float32)
    for f in range(0, frames, p.block):
        m = min(p.block, frames - f)
        first, size = f * p.hop, (m - 1) * p.hop + p.window
        y = np.zeros(size, np.float32)
        have = min(size, n - first)
        if have > 0:
            y[:have] = resample(x, first, have, p)
        cut = np.lib.stride_tricks.as_strided(y, (m, p.window), (p.hop * 4, 4)) * window
        power = np.abs(np.fft.rfft(cut)).astype(np.float32) ** 2
        mels[f : f + m] = 10 * np.log10(power @ mel + 1e-6)
        energy[f : f + m] = 10 * np.log10((cut * cut).mean(axis=1) + 1e-9)
    return mels, energy


def segments(energy: np.ndarray, p: Audio) -> list[tuple[float, float]]:
    """Active spans in seconds: begun above on_db, ended below off_db (relative to the loudest frame)."""
    rel = energy - energy.max()
    said = np.where(rel >= p.on_db, 1, np.where(rel < p.off_db, 0, -1))
    at = np.maximum.accumulate(np.where(said >= 0, np.arange(len(said)), -1))
    active = np.where(at >= 0, said[np.maximum(at, 0)], 0)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], active, [0]])))
    return [(a * p.hop / p.out_rate, ((b - 1) * p.hop + p.window) / p.out_rate) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]


@lru_cache
def tensor_schema(p: Audio) -> pa.Schema:
    return pa.schema([("log_mel", pa.fixed_shape_tensor(pa.float32(), [p.tile, p.mels], dim_names=["frame", "mel"])), ("frames", pa.int32()), ("start_s", pa.float64()), ("end_s", pa.float64())])


def tiles(mels: np.ndarray, p: Audio) -> bytes:
    """The frames as an Arrow IPC stream: a fixed-shape tensor a row, its true frames and its time span."""
    n = -(-len(mels) // p.tile)
    full = np.full((n * p.tile, p.mels), np.float32(-60))
    full[: len(mels)] = mels
    schema = tensor_schema(p)
    storage = pa.FixedSizeListArray.from_arrays(pa.array(full.ravel()), p.tile * p.mels)
    first = np.arange(n) * p.tile
    valid = np.minimum(p.tile, len(mels) - first)
    spans = [first * p.hop / p.out_rate, ((first + valid - 1) * p.hop + p.window) / p.out_rate]
    batch = pa.RecordBatch.from_arrays([pa.ExtensionArray.from_storage(schema.field(0).type, storage), pa.array(valid, pa.int32()), *map(pa.array, spans)], schema=schema)
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, schema) as w:
        w.write_batch(batch)
    return sink.getvalue()


def read_tiles(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, tensors binary, segments array<struct<start_s: double, end_s: double>>"


def stored(media: DataFrame, path: str | None = None) -> DataFrame:
    """Write to_audio()'s rows (in the shared folder, if no path is given) and read them back."""
    path = path or scratch(media.sparkSession, "op4-media")
    media.write.option("compression", "zstd").parquet(path)
    return media.sparkSession.read.schema(media.schema).parquet(path)


def _features(p: Audio):
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "tensors", "segments"]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.struct([("start_s", pa.float64()), ("end_s", pa.float64())])))

    def features(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                out = []
                for doc_id, n_bytes, blob in zip(*(part.column(c).to_pylist() for c in ("doc_id", "n_bytes", "media")), strict=True):
                    _, payload = samples(blob)
                    mels, energy = log_mel(payload, p)
                    out.append((doc_id, n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(blob), hashlib.sha256(blob).hexdigest(), tiles(mels, p), [{"start_s": a, "end_s": b} for a, b in segments(energy, p)]))
                cols = list(zip(*out, strict=True)) or [()] * 9
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return features


def audio_features(media: DataFrame, p: Audio = Audio()) -> DataFrame:
    """Of stored media: checksums of what was read, tensors (Arrow IPC) and active segments."""
    return media.select("doc_id", "n_bytes", "media").mapInArrow(tidied(_features(p)), FEATURES)


def store_features(media: DataFrame, path: str, p: Audio = Audio()) -> DataFrame:
    """Write audio_features(), tensors and all, and read them back."""
    audio_features(media, p).write.option("compression", "zstd").parquet(path)
    return media.sparkSession.read.schema(FEATURES).parquet(path)


def _told(batches):
    for batch in batches:
        out = []
        for blob, spans in zip(batch.column("tensors").to_pylist(), batch.column("segments").to_pylist(), strict=True):
            t = read_tiles(blob)
            column = t.column("log_mel").combine_chunks()
            x = (column.chunk(0) if isinstance(column, pa.ChunkedArray) else column).to_numpy_ndarray()
            valid = t.column("frames").to_numpy()
            bands = x.reshape(-1, x.shape[-1])[(np.arange(x.shape[1]) < valid[:, None]).ravel()].mean(axis=0, dtype=np.float64)
            said = ",".join(f"{s['start_s']:.2f}-{s['end_s']:.2f}" for s in spans)
            out.append(f"frames={int(valid.sum())};tiles={len(valid)};log_mel={','.join(f'{b:.1f}' for b in bands)};segments={len(spans)}:{zlib.crc32(said.encode()):08x}")
        names = [c for c in batch.schema.names if c not in ("tensors", "segments")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(out, pa.string())], names=[*names, "feature"])


DESCRIBED = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def feature_text(features: DataFrame) -> DataFrame:
    """tensors and segments as one string: frames, mean of each mel band and the segments, read from the tensors."""
    return features.mapInArrow(tidied(_told), DESCRIBED)


def described(media: DataFrame, p: Audio = Audio()) -> DataFrame:
    """feature_text() of audio_features(), in one go."""
    features = _features(p)
    return media.select("doc_id", "n_bytes", "media").mapInArrow(tidied(lambda batches: _told(features(batches))), DESCRIBED)


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return described(stored(to_audio(spark.read.parquet(f"{sf_dir}/documents.parquet"))))
