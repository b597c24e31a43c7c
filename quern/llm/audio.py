"""Media columns: bytes stored as 8-bit WAV samples, and fingerprints of pairs of spectral peaks."""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import arrow_map, slices

UNIT, RATE = 64, 8000
#: Samples of a frame, and from one frame's start to the next one's.
FRAME, HOP = 256, 128
#: Frames transformed at once: this bounds memory for very long media and changes no result.
BLOCK = 4096
#: A peak is this many times its frame's mean; it is paired with so many later peaks, at most so many frames away.
OVER_MEAN, FAN_OUT, REACH = 2.0, 3, 31


def pad(raw: bytes) -> bytes:
    """raw with bytes 0 up to a positive multiple of UNIT."""
    return raw + bytes(max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw))


def to_wav(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


def peaks(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Frame and frequency bin of each spectral peak: larger than its neighbours in time and frequency and than its frame's mean."""
    x = np.frombuffer(samples, np.uint8).astype(np.float32) - 128
    whole = FRAME + max(0, -(-(len(x) - FRAME) // HOP)) * HOP  # so that the last samples are in a frame
    x = np.concatenate([x, np.zeros(whole - len(x), np.float32)])
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    hann, found = np.hanning(FRAME).astype(np.float32), []
    for at in range(0, len(frames), BLOCK):
        first, last = max(0, at - 1), min(len(frames), at + BLOCK + 1)
        power = np.abs(np.fft.rfft(frames[first:last] * hann, axis=1)).astype(np.float32)
        wide = np.pad(power, 1, constant_values=-1)
        top = (power > wide[1:-1, :-2]) & (power > wide[1:-1, 2:]) & (power > wide[:-2, 1:-1]) & (power >= wide[2:, 1:-1])
        top &= power > OVER_MEAN * power.mean(axis=1, keepdims=True)
        t, f = np.nonzero(top[at - first : at - first + BLOCK])
        found.append((t + at, f))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def fingerprint(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Times (frames) and codes of pairs of peaks: code = first bin * 2**13 + second bin * 2**5 + distance in frames."""
    t, f = peaks(samples)
    times, codes = [t[:0]], [t[:0]]
    for k in range(1, FAN_OUT + 1):
        apart = t[k:] - t[:-k]
        near = apart <= REACH
        times.append(t[:-k][near])
        codes.append((f[:-k][near] << 13) | (f[k:][near] << 5) | apart[near])
    times, codes = np.concatenate(times), np.concatenate(codes)
    order = np.lexsort((codes, times))
    return times[order].astype("<i4"), codes[order].astype("<i4")


def media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its WAV (media), and the time-coded fingerprint read back from it (times, codes).

    A null or empty text is 64 zero bytes. Repeated rows give repeated rows, an empty table none; of peaks that tie
    in time the first is one. Other columns are ignored, whatever their names.
    """

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in slices(batch, 4 << 20):
            stored = [to_wav(pad(x or b"")) for x in part.column(1).to_pylist()]
            found = [fingerprint(from_wav(x)) for x in stored]
            yield {"doc_id": part.column(0), "media": stored, "times": [x[0] for x in found], "codes": [x[1] for x in found]}

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(docs.select(id_col, F.col(text_col).cast("binary")), step, f"doc_id {kind}, media binary, times array<int>, codes array<int>")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the sizes and digests of payload and media, and a digest of the fingerprint (feature).

    feature is the number of pairs, a colon, and the first 32 hex digits of the SHA-256 of times and codes.
    Nulls, empty texts, ties, repeated rows, empty tables and other columns as in media().
    """

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in slices(batch):
            out: dict[str, list] = {k: [] for k in ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")}
            for raw in part.column(1).to_pylist():
                stored = to_wav(pad(raw or b""))
                payload = from_wav(stored)
                times, codes = fingerprint(payload)
                code = hashlib.sha256(times.tobytes() + codes.tobytes()).hexdigest()[:32]
                for k, v in zip(out, (len(raw or b""), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(stored), hashlib.sha256(stored).hexdigest(), f"{len(times)}:{code}"), strict=True):
                    out[k].append(v)
            yield {"doc_id": part.column(0)} | out

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return arrow_map(docs.select(id_col, F.col(text_col).cast("binary")), step, schema)
