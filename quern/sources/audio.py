"""WAV bytes to samples and back, and the signal functions that need NumPy.

These run in Arrow batches. A file that can't be parsed gives nulls and the reason, not a failed task.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WAV_SCHEMA = "rate int, channels int, frames long, duration_s double, samples array<float>, error string"


def read_wav(raw: bytes | None) -> tuple:
    """Rate, channels, frames, seconds, samples as the mean over channels, and why it failed; all others are null then."""
    try:
        with wave.open(io.BytesIO(raw)) as w:
            rate, channels, frames, width = w.getframerate(), w.getnchannels(), w.getnframes(), w.getsampwidth()
            data = w.readframes(frames)
        if width == 1:
            x = (np.frombuffer(data, np.uint8).astype(np.float32) - 128) / 128
        elif width == 3:
            parts = np.frombuffer(data, np.uint8).reshape(-1, 3).astype(np.int32)
            x = ((parts[:, 0] << 8 | parts[:, 1] << 16 | parts[:, 2] << 24) >> 8).astype(np.float32) / 2**23
        else:
            x = np.frombuffer(data, {2: "<i2", 4: "<i4"}[width]).astype(np.float32) / 2.0 ** (8 * width - 1)
        return rate, channels, frames, frames / rate, x.reshape(-1, channels).mean(axis=1), None
    except Exception as e:
        return None, None, None, None, None, f"{type(e).__name__}: {e}"


def scan_audio(files: DataFrame, key: str, content: str = "content", target: int | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, rate, channels, frames, duration_s, samples, error) of WAV bytes; the samples at the rate ``target``, if given; ``keep``: other columns to hand on."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(k, *read_wav(raw)) for k, raw in zip(frame[key], frame[content], strict=True)]
            out = pd.DataFrame(rows, columns=[key, "rate", "channels", "frames", "duration_s", "samples", "error"])
            if target:
                out["samples"] = [None if x is None else resample(x, int(rate), target).astype(np.float32) for x, rate in zip(out["samples"], out["rate"], strict=True)]
            for name in keep:
                out[name] = frame[name].to_numpy()
            yield out.astype({"rate": "Int32", "channels": "Int32", "frames": "Int64"})

    kind = lambda name: f"{name} {files.schema[name].dataType.simpleString()}"
    return files.select(key, *keep, content).mapInPandas(run, ", ".join([kind(key), WAV_SCHEMA, *map(kind, keep)]))


def to_wav(pcm: Column, rate: int) -> Column:
    """Mono 16-bit WAV bytes of an array of 16-bit samples, native: a 44-byte header and the samples."""
    little = lambda x, size: F.unhex(F.concat(*[F.lpad(F.hex(F.shiftright(x, 8 * k).bitwiseAND(255)), 2, "0") for k in range(size)]))
    n = F.size(pcm) * 2
    words = F.transform(pcm, lambda s: F.concat(F.lpad(F.hex(s.cast("int").bitwiseAND(255)), 2, "0"), F.lpad(F.hex(F.shiftright(s.cast("int"), 8).bitwiseAND(255)), 2, "0")))
    fixed = b"WAVEfmt " + (16).to_bytes(4, "little") + (1).to_bytes(2, "little") * 2 + rate.to_bytes(4, "little") + (2 * rate).to_bytes(4, "little") + (2).to_bytes(2, "little") + (16).to_bytes(2, "little") + b"data"
    return F.concat(F.lit(b"RIFF"), little(n + 36, 4), F.lit(fixed), little(n, 4), F.unhex(F.array_join(words, "")))


def spectral_centroid(x: np.ndarray, rate: int, frame: int = 2048, hop: int = 512) -> float:
    """Mean over centred, windowed frames of the magnitude-weighted frequency; 0 for silence."""
    x = np.pad(np.asarray(x, np.float64), frame // 2)
    window = np.hanning(frame + 1)[:-1]
    starts = range(0, len(x) - frame + 1, hop)
    spectra = np.abs(np.fft.rfft(np.stack([x[s : s + frame] * window for s in starts]), axis=1))
    total = spectra.sum(axis=1)
    freq = np.fft.rfftfreq(frame, 1 / rate)
    return float(np.where(total > 0, (spectra * freq).sum(axis=1) / np.where(total > 0, total, 1), 0).mean())


def resample(x: np.ndarray, rate: int, target: int) -> np.ndarray:
    """Windowed-sinc interpolation with the cutoff of the lower rate; the same rate returns the input."""
    x = np.asarray(x, np.float64)
    if rate == target or not len(x):
        return x
    n, low, half = int(np.ceil(len(x) * target / rate)), min(1.0, target / rate), 32
    reach = int(np.ceil(half / low))
    at = np.arange(n) * rate / target
    near = np.floor(at).astype(np.int64)[:, None] + np.arange(-reach + 1, reach + 1)
    apart = at[:, None] - near
    weights = low * np.sinc(low * apart) * (0.5 + 0.5 * np.cos(np.pi * np.clip(apart / reach, -1, 1)))
    return (np.where((near >= 0) & (near < len(x)), x[np.clip(near, 0, len(x) - 1)], 0) * weights).sum(axis=1)


def spectral_centroids(rows: DataFrame, key: str, samples: str, rate: int, frame: int = 2048, hop: int = 512) -> DataFrame:
    """(key, centroid) per clip; null samples give null."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({key: f[key], "centroid": [None if x is None else spectral_centroid(x, rate, frame, hop) for x in f[samples]]})

    return rows.select(key, samples).mapInPandas(run, f"{key} {rows.schema[key].dataType.simpleString()}, centroid double")


def resampled(rows: DataFrame, key: str, samples: str, rate: int, target: int) -> DataFrame:
    """(key, samples) at another rate."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({key: f[key], "samples": [None if x is None else resample(x, rate, target) for x in f[samples]]})

    return rows.select(key, samples).mapInPandas(run, f"{key} {rows.schema[key].dataType.simpleString()}, samples array<double>")
