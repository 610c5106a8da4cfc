"""Media columns: text bytes as WAV samples, and spectral-peak pair fingerprints read back from them."""

from __future__ import annotations

import hashlib
import io
import wave
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from wardlake.llm.common import table

RATE, UNIT = 8000, 64
FRAME, HOP = 256, 128
BANDS = ((1, 8), (8, 24), (24, 56), (56, 129))
FAN, REACH = 3, 63
FRAMES_AT_ONCE = 4096
_window = np.hanning(FRAME).astype(np.float32)


def wav(text: str | None) -> bytes:
    """The UTF-8 bytes, filled with zeros to a positive multiple of UNIT, as 8-bit mono samples. A null is empty."""
    data = (text or "").encode("utf-8", "replace")
    data += bytes(-len(data) % UNIT or (0 if data else UNIT))
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(data)
    return out.getvalue()


def samples(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


def spectral_peaks(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Times (in hops) and bins of the strongest bin of each band of each frame, where it is stronger than in the next frame
    and no weaker than in the one before. The whole payload, filled with silence to whole frames, some thousand frames at a
    time."""
    x = np.frombuffer(payload, dtype=np.uint8)
    n = 1 + max(0, -(-(len(x) - FRAME) // HOP))
    x = np.pad(x, (0, (n - 1) * HOP + FRAME - len(x)), constant_values=128)
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    times, tones = [], []
    for i in range(0, n, FRAMES_AT_ONCE):
        low, high = max(0, i - 1), min(n, i + FRAMES_AT_ONCE + 1)
        power = np.abs(np.fft.rfft((frames[low:high].astype(np.float32) - 128) * _window, axis=1)).astype(np.float32)
        own = np.arange(i, min(n, i + FRAMES_AT_ONCE))
        none = np.zeros((1, power.shape[1]), dtype=np.float32)
        padded = np.concatenate([none if low == i else power[:0], power, none if high == own[-1] + 1 else power[:0]])
        for a, b in BANDS:
            at = padded[1 : len(own) + 1, a:b].argmax(1) + a
            k = np.arange(len(own))
            here = padded[k + 1, at]
            peak = (here > padded[k + 2, at]) & (here >= padded[k, at]) & (here > 1e-3)
            times.append(own[peak])
            tones.append(at[peak])
    t, f = np.concatenate(times), np.concatenate(tones)
    order = np.lexsort((f, t))
    return t[order], f[order]


def peak_pairs(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(times, prints): each peak with the next FAN within REACH; a print holds both bins and the time between."""
    t, f = spectral_peaks(payload)
    times, prints = [], []
    for k in range(1, FAN + 1):
        gap = t[k:] - t[:-k]
        near = gap <= REACH
        times.append(t[:-k][near])
        prints.append((f[:-k][near].astype(np.int64) << 14) | (f[k:][near] << 6) | gap[near])
    t, p = np.concatenate(times), np.concatenate(prints)
    order = np.lexsort((p, t))
    return t[order].astype(np.int32), p[order].astype(np.int32)


@F.pandas_udf(BinaryType())
def wav_of(text: pd.Series) -> pd.Series:
    return pd.Series([wav(t) for t in text], dtype=object)


@F.pandas_udf(StructType([StructField(n, t) for n, t in (("payload_bytes", LongType()), ("payload_sha256", StringType()), ("tail_crc32", LongType()), ("times", ArrayType(IntegerType())), ("prints", ArrayType(IntegerType())))]))
def read_back(media: pd.Series) -> pd.DataFrame:
    rows = []
    for m in media:
        payload = samples(m)
        rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), *peak_pairs(payload)))
    return pd.DataFrame(rows, columns=["payload_bytes", "payload_sha256", "tail_crc32", "times", "prints"])


def with_media(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with media, the text as a WAV file, and audio: what reading it back gives (payload_bytes, payload_sha256,
    tail_crc32, and the fingerprint as the arrays times and prints, of one length, in order of time).

    Every row stays and columns of these names are replaced. Null and empty texts become UNIT zeros. Equal texts get equal
    values, repeated rows and ids too; an empty table stays empty. Each row is worked on alone, a block of frames at a
    time, so a very long text takes its own bytes a few times over.
    """
    return docs.withColumn("media", wav_of(F.col(text))).withColumn("audio", read_back(F.col("media")))


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's media facts and fingerprint: a digest of it as feature, and the arrays themselves."""
    made = with_media(table(spark, sf_dir, "documents").select("doc_id", "text"))
    feature = F.concat_ws(":", F.size("audio.prints").cast("string"), F.lower(F.hex(F.xxhash64("audio.times", "audio.prints"))))
    return made.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "audio.payload_bytes",
        "audio.payload_sha256",
        "audio.tail_crc32",
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        feature.alias("feature"),
        "audio.times",
        "audio.prints",
    )
