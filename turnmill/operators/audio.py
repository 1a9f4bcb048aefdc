"""Recordings as samples: decoding, probing, cutting and encoding in Arrow batches.

WAV needs nothing but the standard library. Other formats need the optional package ``soundfile``; where it is missing,
their rows carry an error instead of samples. A file that can't be read never fails its task.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Segments of a recording that are cut at once, on average.
SEGMENTS = 2_000
PROBED = "path string, sample_rate int, channels int, frames bigint, duration double, bits int, file_size bigint, error string"
DECODED = "path string, sample_rate int, samples array<float>, error string"
CUT = "segment_id string, sample_rate int, bytes binary, error string"


def _other(content: bytes) -> tuple[np.ndarray, int, int]:
    try:
        import soundfile
    except ImportError as e:
        raise ValueError("only WAV can be read without the package soundfile") from e
    x, rate = soundfile.read(io.BytesIO(content), dtype="float32", always_2d=True)
    return x.T, rate, 32


def decode(content: bytes) -> tuple[np.ndarray, int, int]:
    """Samples [channel, time] from -1 to 1, rate and bits of a file's content."""
    if content[:4] != b"RIFF":
        return _other(content)
    with wave.open(io.BytesIO(content)) as w:
        width, n, rate = w.getsampwidth(), w.getnchannels(), w.getframerate()
        raw = w.readframes(w.getnframes())
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 2:
        x = np.frombuffer(raw, "<i2").astype(np.float32) / (1 << 15)
    elif width == 4:
        x = np.frombuffer(raw, "<i4").astype(np.float32) / (1 << 31)
    else:
        raise ValueError(f"samples of {width} bytes")
    return x.reshape(-1, n).T, rate, 8 * width


def encode(samples: np.ndarray, rate: int) -> bytes:
    """16-bit WAV of mono samples or of [channel, time]."""
    x = np.atleast_2d(samples)
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(x.shape[0])
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(x.T, -1, 1 - 1 / (1 << 15)) * (1 << 15)).round().astype("<i2").tobytes())
    return out.getvalue()


def probe(files: DataFrame) -> DataFrame:
    """Rate, channels, length and size of files (path, content)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for path, content in zip(f["path"], f["content"]):
                try:
                    x, rate, bits = decode(content)
                    rows.append((path, rate, x.shape[0], x.shape[1], x.shape[1] / rate, bits, len(content), None))
                except Exception as e:  # noqa: BLE001 - told in the row
                    rows.append((path, None, None, None, None, None, len(content) if content else 0, str(e) or type(e).__name__))
            out = pd.DataFrame(rows, columns=["path", "sample_rate", "channels", "frames", "duration", "bits", "file_size", "error"])
            yield out.astype({"sample_rate": "Int32", "channels": "Int32", "frames": "Int64", "bits": "Int32"})

    return files.select("path", "content").mapInPandas(run, PROBED)


def mono_samples(files: DataFrame) -> DataFrame:
    """Mean of all channels of files (path, content)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for path, content in zip(f["path"], f["content"]):
                try:
                    x, rate, _ = decode(content)
                    rows.append((path, rate, x.mean(axis=0).astype(np.float32), None))
                except Exception as e:  # noqa: BLE001
                    rows.append((path, None, None, str(e) or type(e).__name__))
            yield pd.DataFrame(rows, columns=["path", "sample_rate", "samples", "error"]).astype({"sample_rate": "Int32"})

    return files.select("path", "content").mapInPandas(run, DECODED)


def cut_segments(segments: DataFrame, files: DataFrame) -> DataFrame:
    """WAV bytes of segments (segment_id, path, start_sec, end_sec) of files (path, content), rounded to the nearest sample.

    A recording is decoded once for every so many of its segments, which come as one array; a reversed or missing range, or
    one beyond the recording, gives an error row. Segments of recordings that aren't there give none.
    """
    shares = segments.groupBy("path").agg(F.ceil(F.count(F.lit(1)) / SEGMENTS).alias("_shares"))
    per = (segments.join(shares, "path").groupBy("path", F.pmod(F.xxhash64("segment_id"), F.col("_shares")).alias("_share"))
           .agg(F.collect_list(F.struct("segment_id", "start_sec", "end_sec")).alias("parts")).drop("_share"))
    joined = files.select("path", "content").join(per, "path")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for content, parts in zip(f["content"], f["parts"]):
                rows = []
                try:
                    x, rate, _ = decode(content)
                    wrong = None
                except Exception as e:  # noqa: BLE001
                    x, rate, wrong = None, None, str(e) or type(e).__name__
                for p in parts:
                    a, b = p["start_sec"], p["end_sec"]
                    if wrong:
                        rows.append((p["segment_id"], None, None, wrong))
                    elif a is None or b is None or not a < b:
                        rows.append((p["segment_id"], rate, None, "no range"))
                    elif b > x.shape[1] / rate + 1 / rate:
                        rows.append((p["segment_id"], rate, None, "beyond the recording"))
                    else:
                        rows.append((p["segment_id"], rate, encode(x[:, round(a * rate):round(b * rate)], rate), None))
                yield pd.DataFrame(rows, columns=["segment_id", "sample_rate", "bytes", "error"]).astype({"sample_rate": "Int32"})

    return joined.select("content", "parts").mapInPandas(run, CUT)
