"""Audio features of stored media: polyphase resampling, log-mel filterbanks, energy segments.

Media are RIFF/WAVE files of mono 8-bit samples. Features are read from the stored bytes: samples are
resampled from the file's own rate to TARGET by a rational factor with a polyphase FIR filter (5/8 for
files of RATE), cut into overlapped frames, turned into log-mel energies, and loud stretches are found by
two thresholds (hysteresis). Frames are kept as patches of fixed shape, PATCH_FRAMES x MELS, each with its
time span; tensors() reads that column as Arrow's fixed-shape tensors.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from math import gcd

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, read_table, workers_see_package

#: Samples a second of media stored here, and of what features are made from; filter taps for each phase at a factor of 1 or more.
RATE, TARGET, TAPS = 16_000, 10_000, 16
FRAME, HOP, MELS, PATCH_FRAMES = 512, 256, 24, 32
#: Hysteresis: a segment opens at the first and closes below the second, in nats above the mean log energy.
OPEN_AT, CLOSE_AT = 0.05, -0.05
ALIGN = 64
#: Samples that one step of the resampler and the filterbank handles: memory doesn't follow the length of a file.
BLOCK_FRAMES = 1024


def encode(payload: bytes, rate: int = RATE) -> bytes:
    """A WAVE file whose 8-bit samples are the payload, byte for byte."""
    n = len(payload)
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + n + n % 2, b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", n)
    return head + payload + b"\0" * (n % 2)


def decode(media: bytes) -> tuple[bytes, int]:
    """(samples, rate) of a WAVE file with one 8-bit channel; chunks may come in any order."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAVE file")
    at, rate, samples = 12, None, None
    while at + 8 <= len(media):
        name, n = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", media, at + 8)
            if (kind, channels, bits) != (1, 1, 8):
                raise ValueError("not mono 8-bit PCM")
        elif name == b"data":
            samples = media[at + 8 : at + 8 + n]
        at += 8 + n + n % 2
    if rate is None or samples is None:
        raise ValueError("a chunk is missing")
    return samples, rate


def factor(rate: int) -> tuple[int, int]:
    """(up, down): TARGET / rate in lowest terms."""
    if rate <= 0:
        raise ValueError("no sample rate")
    common = gcd(TARGET, rate)
    return TARGET // common, rate // common


@lru_cache(maxsize=8)
def prototype(up: int, down: int) -> np.ndarray:
    """Low-pass prototype (windowed sinc, cut off at the lower of both rates) as up phases x taps; every phase sums to 1."""
    taps = TAPS * max(1, -(-down // up))
    n = up * taps
    t = np.arange(n) - (n - 1) / 2
    h = np.sinc(t / max(up, down)) * np.hamming(n)
    phases = h.reshape(taps, up).T
    return (phases / phases.sum(1, keepdims=True)).astype(np.float32)


def resample(x: np.ndarray, up: int, down: int, start: int, stop: int) -> np.ndarray:
    """Output samples start..stop-1 of the polyphase resampler over x (bytes, 128 is 0); beyond its ends the signal is 0.

    Output k uses phase (k * down) mod up and the taps of x that end at (k * down) // up + taps // 2. Every up-th
    output has one phase and inputs that are down apart, so a phase is one product of a strided view.
    """
    phases = prototype(up, down)
    taps = phases.shape[1]
    end = lambda k: k * down // up + taps // 2
    low, high = end(start) - taps + 1, end(stop - 1) + 1
    piece = np.zeros(high - low, np.float32)
    a, b = max(low, 0), min(high, len(x))
    if a < b:
        piece[a - low : b - low] = (x[a:b].astype(np.float32) - 128) / 128
    runs = np.lib.stride_tricks.sliding_window_view(piece, taps)
    out = np.empty(stop - start, np.float32)
    for first in range(start, min(stop, start + up)):
        n = len(range(first, stop, up))
        view = runs[end(first) - taps + 1 - low :: down][:n]
        out[first - start :: up] = view @ phases[first * down % up][::-1]
    return out


def mel_bank(rate: float, mels: int = MELS, frame: int = FRAME) -> np.ndarray:
    """Triangular filters, frequency bins x mels."""
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(0, mel(rate / 2), mels + 2) / 2595) - 1)
    f = np.fft.rfftfreq(frame, 1 / rate)[:, None]
    return np.maximum(0, np.minimum((f - edges[:-2]) / (edges[1:-1] - edges[:-2]), (edges[2:] - f) / (edges[2:] - edges[1:-1]))).astype(np.float32)


_WINDOW = np.hanning(FRAME + 1)[:-1].astype(np.float32)
_BANK = mel_bank(TARGET)


def log_mel(samples: bytes, rate: int = RATE) -> np.ndarray:
    """Frames x MELS of the resampled signal; a last partial frame is filled with 0, one frame at least."""
    x = np.frombuffer(samples, np.uint8)
    up, down = factor(rate)
    total = -(-len(x) * up // down)
    frames = max(1, -(-max(0, total - FRAME) // HOP) + 1)
    out = np.empty((frames, MELS), np.float32)
    for a in range(0, frames, BLOCK_FRAMES):
        b = min(frames, a + BLOCK_FRAMES)
        start, stop = a * HOP, (b - 1) * HOP + FRAME
        y = np.zeros(stop - start, np.float32)
        if total > start:
            done = resample(x, up, down, start, min(stop, total))
            y[: len(done)] = done
        view = np.lib.stride_tricks.sliding_window_view(y, FRAME)[::HOP]
        power = np.abs(np.fft.rfft(view * _WINDOW, axis=1)).astype(np.float32) ** 2
        out[a:b] = np.log(power @ _BANK + 1e-6)
    return out


def segments(mel: np.ndarray, open_at: float = OPEN_AT, close_at: float = CLOSE_AT) -> list[tuple[int, int]]:
    """Frame ranges (end exclusive) that start above open_at and last until energy falls below close_at."""
    energy = np.log(np.exp(mel.astype(np.float64)).sum(1))
    energy -= energy.mean()
    # State after a frame: 1 above open_at, 0 below close_at, else the state before it.
    mark = np.where(energy >= open_at, 1, np.where(energy < close_at, 0, -1))
    known = np.where(mark >= 0, np.arange(len(mark)), -1)
    last = np.maximum.accumulate(known)
    state = np.where(last >= 0, mark[last], 0)
    edge = np.diff(np.concatenate([[0], state, [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))


def seconds(frame: int, end: bool = False) -> float:
    return (frame * HOP + (FRAME - HOP) * end) / TARGET


def patches(mel: np.ndarray) -> list[dict]:
    """Patches of PATCH_FRAMES x MELS values in a row, with their time spans; the last one is filled up with 0."""
    n = -(-len(mel) // PATCH_FRAMES)
    filled = np.zeros((n * PATCH_FRAMES, MELS), np.float32)
    filled[: len(mel)] = mel
    spans = ((k * PATCH_FRAMES, min((k + 1) * PATCH_FRAMES, len(mel))) for k in range(n))
    return [{"start_s": seconds(a), "end_s": seconds(b - 1, True), "values": v} for (a, b), v in zip(spans, filled.reshape(n, -1), strict=True)]


def tensors(column: pa.ListArray | pa.ChunkedArray) -> pa.FixedShapeTensorArray:
    """The values of a patches column as Arrow tensors float32[PATCH_FRAMES, MELS], one for each patch, without a copy of the numbers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = pc.struct_field(column.flatten(), "values")
    size = PATCH_FRAMES * MELS
    return pa.ExtensionArray.from_storage(pa.fixed_shape_tensor(pa.float32(), (PATCH_FRAMES, MELS)), pa.FixedSizeListArray.from_arrays(values.flatten().cast(pa.float32()), size))


def store(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: every text's UTF-8 bytes, with zeros to a positive multiple of ALIGN, as a WAVE file.

    docs: doc_id, text; other columns are ignored. A null text counts as empty. No rows: no rows out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _small(batch, "text"):
                raw = [(t or "").encode() for t in part.column("text").to_pylist()]
                media = [encode(r + bytes(-len(r) % ALIGN if r else ALIGN)) for r in raw]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(map(len, raw), pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    workers_see_package(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


def _small(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``most`` bytes in the column."""
    size = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    group = np.cumsum(size) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


FEATURE_SCHEMA = (
    "payload_bytes long, payload_sha256 string, tail_crc32 long, rate int, frames long, patches array<struct<start_s:double,end_s:double,values:array<float>>>, "
    "segments array<struct<start_s:double,end_s:double>>, mean array<float>"
)


def audio_features(media: DataFrame, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Features of stored WAVE files: the named columns, media, and FEATURE_SCHEMA.

    A null file has null features; a file that isn't mono 8-bit WAVE fails the job. Equal files, equal features.
    Times are seconds of the file, by its own rate.
    """
    kept = media.select(*columns, "media")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patch = pa.struct([("start_s", pa.float64()), ("end_s", pa.float64()), ("values", pa.list_(pa.float32()))])
        schema = pa.schema([("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("rate", pa.int32()), ("frames", pa.int64()), ("patches", pa.list_(patch)), ("segments", pa.list_(pa.struct([("start_s", pa.float64()), ("end_s", pa.float64())]))), ("mean", pa.list_(pa.float32()))])
        for batch in batches:
            for part in _small(batch, "media"):
                rows = []
                for m in part.column("media"):
                    if not m.is_valid:
                        rows.append(dict.fromkeys(schema.names))
                        continue
                    samples, rate = decode(m.as_py())
                    mel = log_mel(samples, rate)
                    rows.append({
                        "payload_bytes": len(samples), "payload_sha256": hashlib.sha256(samples).hexdigest(), "tail_crc32": zlib.crc32(samples[-ALIGN:]), "rate": rate, "frames": len(mel), "patches": patches(mel),
                        "segments": [{"start_s": seconds(a), "end_s": seconds(b - 1, True)} for a, b in segments(mel)], "mean": mel.mean(0),
                    })
                found = pa.RecordBatch.from_pylist(rows, schema)
                yield pa.RecordBatch.from_arrays([*part.columns, *found.columns], [*columns, "media", *schema.names])

    workers_see_package(media.sparkSession)
    shape = ", ".join(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in columns)
    return kept.mapInArrow(run, f"{shape}, media binary, {FEATURE_SCHEMA}")


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = Scratch(spark, "op5").table(store(read_table(spark, sf_dir, "documents")), "media")
    found = audio_features(stored, ("doc_id", "n_bytes"))
    spoken = F.aggregate("segments", F.lit(0.0), lambda s, x: s + x["end_s"] - x["start_s"])
    feature = F.concat_ws(
        ";", F.concat(F.lit("frames="), "frames"), F.concat(F.lit("segments="), F.size("segments")), F.concat(F.lit("active_s="), F.round(spoken, 3)),
        F.concat(F.lit("mel="), F.array_join(F.transform("mean", lambda x: F.round(x.cast("double"), 2).cast("string")), ",")), F.concat(F.lit("patches="), F.size("patches")),
    )
    return found.select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), feature.alias("feature"),
    )
