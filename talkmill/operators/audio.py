"""Recordings as sample arrays: decoding, mono, 16 kHz, silence trimming, in Arrow batches.

WAV is decoded here. Other media need a decoder: a function of a file's bytes that gives its rate and a (channels,
samples) array, or raises; decoders are given by media type, and run in the tasks.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmill.functions import paths

RATE = 16_000
FRAME_SECONDS, TRIGGER = 0.02, 0.5
#: Silence: the quantile of frame energies that is the noise, the share of the loud quantile and the multiple of the noise
#: at which sound begins, and the part of that level down to which it goes back.
QUIET, LOUD, OVER_NOISE, GO_BACK = 0.1, 0.9, 16.0, 0.25

DECODED = "path string, sample_rate int, duration double, channels array<array<float>>, error string"
PREPARED = "path string, size_bytes long, duration double, samples array<float>, error string"

Decoder = Callable[[bytes], tuple[int, np.ndarray]]


def decode_wav(content: bytes) -> tuple[int, np.ndarray]:
    """Rate and a (channels, samples) array of 32-bit floats from -1 to 1, of integer PCM of 8 to 32 bits."""
    with wave.open(io.BytesIO(content)) as f:
        rate, width, n, raw = f.getframerate(), f.getsampwidth(), f.getnchannels(), f.readframes(f.getnframes())
        if len(raw) < f.getnframes() * width * n:
            raise ValueError("truncated")
    if width == 1:
        values = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        values = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8).astype(np.float32) / (1 << 23)
    else:
        values = np.frombuffer(raw, f"<i{width}").astype(np.float32) / float(1 << (8 * width - 1))
    return rate, values.reshape(-1, n).T


def probe_wav(content: bytes) -> float:
    """Seconds by the header alone."""
    with wave.open(io.BytesIO(content)) as f:
        return f.getnframes() / f.getframerate()


def to_mono(channels: np.ndarray) -> np.ndarray:
    return channels[0] if len(channels) == 1 else channels.mean(axis=0, dtype=np.float32)


@lru_cache(maxsize=32)
def filter_bank(num: int, den: int, taps: int) -> np.ndarray:
    """Weights of a windowed sinc, a row for each phase of the ratio num / den, from the tap half - 1 before a sample to the one half after it."""
    cut = min(1.0, num / den)
    half = int(np.ceil(taps / cut))
    x = (np.arange(num) * den % num)[:, None] / num - np.arange(-half + 1, half + 1)
    return cut * np.sinc(cut * x) * np.where(np.abs(x) < half, 0.5 + 0.5 * np.cos(np.pi * x / half), 0)


def resample(samples: np.ndarray, rate: int, target: int = RATE, taps: int = 16) -> np.ndarray:
    """Windowed-sinc interpolation of one recording, or of several of a length (rows), low-pass at the lower of both rates.

    Output i lies at sample i * den / num, so there are num phases; each has its weights once, and is a product of them
    with every den-th window of samples. Numerically close to other resamplers, not equal.
    """
    length = samples.shape[-1]
    if rate == target or not length:
        return samples.astype(np.float32)
    ratio = Fraction(target, rate)
    num, den = ratio.numerator, ratio.denominator
    bank = filter_bank(num, den, taps)
    half = bank.shape[1] // 2
    n = -(-length * num // den)
    beyond = max(0, (n - 1) * den // num + half - length + 1)
    edge = [(0, 0)] * (samples.ndim - 1) + [(half - 1, beyond)]
    windows = np.lib.stride_tricks.sliding_window_view(np.pad(samples.astype(np.float64), edge), 2 * half, axis=-1)
    out = np.empty((*samples.shape[:-1], n), np.float32)
    for phase in range(min(num, n)):
        count = -(-(n - phase) // num)
        first = phase * den // num
        out[..., phase::num] = windows[..., first : first + (count - 1) * den + 1 : den, :] @ bank[phase]
    return out


def trim_silence(samples: np.ndarray, rate: int = RATE, trigger: float = TRIGGER) -> np.ndarray:
    """Drop what precedes the first sound. An approximation of voice-activity trimming; a silent recording stays as it is.

    Sound begins at the first frame with a share (trigger / 10) of the energy that one frame in ten exceeds, or with
    OVER_NOISE times that of the noise, which one in ten falls below, if that is less; from there it goes back over frames
    of at least GO_BACK of that level. A few loud frames change neither quantile, so a click doesn't hide quiet speech.
    """
    n = max(1, int(rate * FRAME_SECONDS))
    frames = len(samples) // n
    if not frames:
        return samples
    energy = (samples[: frames * n].reshape(frames, n).astype(np.float64) ** 2).mean(axis=1)
    noise, loud = np.quantile(energy, [QUIET, LOUD])
    level = min(trigger / 10 * loud, OVER_NOISE * noise) if noise > 0 else trigger / 10 * loud
    above = np.flatnonzero(energy > level) if energy.max() > 0 else []
    if not len(above):
        return samples
    quiet = np.flatnonzero(energy[: above[0]] <= GO_BACK * level)
    return samples[(quiet[-1] + 1 if len(quiet) else 0) * n :]


def _each(files: DataFrame, handle: Callable[[str, bytes], dict], schema: str) -> DataFrame:
    """files (path, content) through a function of both; what raises leaves nulls and its message in error."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                known = {"path": path, "error": None, "size_bytes": len(content)}
                try:
                    rows.append(known | handle(path, content))
                except Exception as e:  # noqa: BLE001  any unreadable file is a row with an error
                    rows.append(known | {"error": f"{type(e).__name__}: {e}"})
            yield pd.DataFrame({n: pd.Series([r.get(n) for r in rows], dtype=object) for n in names})

    return files.select("path", "content").mapInPandas(run, schema)


def media_of(path: str) -> str | None:
    """Media type by extension, in any case; as paths.media_type, in a task."""
    return paths.MEDIA_TYPES.get(path.rpartition("/")[2].rpartition(".")[2].lower())


def decoder_of(decoders: dict[str, Decoder] | None) -> Callable[[str, bytes], tuple[int, np.ndarray]]:
    """Decode by the path's media type. WAV is known unless another decoder is given for it; files of unknown media are tried as WAV."""
    known = {paths.MEDIA_TYPES["wav"]: decode_wav} | (decoders or {})

    def decode(path: str, content: bytes) -> tuple[int, np.ndarray]:
        media = media_of(path)
        if media is not None and media not in known:
            raise ValueError(f"no decoder for {media}")
        rate, channels = known.get(media, decode_wav)(content)
        channels = np.atleast_2d(np.asarray(channels, np.float32))
        if rate <= 0 or not channels.shape[0]:
            raise ValueError("no sound")
        return int(rate), channels

    return decode


def load(files: DataFrame, decoders: dict[str, Decoder] | None = None) -> DataFrame:
    """Decode files: rate, duration and channels, or an error. Rows with an error are invalid recordings."""
    decode = decoder_of(decoders)

    def handle(path: str, content: bytes) -> dict:
        rate, channels = decode(path, content)
        return {"sample_rate": rate, "duration": channels.shape[1] / rate, "channels": list(channels)}

    return _each(files, handle, DECODED)


def probe(files: DataFrame, decoders: dict[str, Decoder] | None = None) -> DataFrame:
    """path, duration and error of each file; a null duration marks an invalid one. Of WAV only the header is read."""
    decode, wav = decoder_of(decoders), paths.MEDIA_TYPES["wav"]

    def handle(path: str, content: bytes) -> dict:
        if media_of(path) in (None, wav) and wav not in (decoders or {}):
            return {"duration": probe_wav(content)}
        rate, channels = decode(path, content)
        return {"duration": channels.shape[1] / rate}

    return _each(files, handle, "path string, duration double, error string")


def preprocess(files: DataFrame, rate: int = RATE, decoders: dict[str, Decoder] | None = None) -> DataFrame:
    """Decode, mono, resample, trim: one pass in each task, the duration as it was before trimming. Errors go to a column."""
    decode = decoder_of(decoders)

    def handle(path: str, content: bytes) -> dict:
        own, channels = decode(path, content)
        mono = to_mono(channels)
        return {"duration": len(mono) / own, "samples": trim_silence(resample(mono, own, rate), rate)}

    return _each(files, handle, PREPARED)


def split_valid(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a duration, and rows without."""
    return decoded.where("duration is not null"), decoded.where("duration is null")


def encode_wav(samples: np.ndarray, rate: int = RATE) -> bytes:
    """Samples from -1 to 1 as a mono WAV file of 16 bits."""
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes((np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def wav_files(rows: DataFrame, path: Column, samples: Column, rate: int = RATE) -> DataFrame:
    """path and content: arrays of samples as WAV files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "content": [encode_wav(np.asarray(x, np.float32), rate) for x in batch["samples"]]})

    return rows.select(path.alias("path"), samples.alias("samples")).mapInPandas(run, "path string, content binary")


def resampled(samples: Column, rate: int, target: int = RATE) -> Column:
    """Arrays of samples at another rate."""

    @F.pandas_udf("array<float>")
    def convert(chunk: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(chunk), index=chunk.index, dtype="object")
        for _, same in chunk.dropna().groupby(chunk.map(len, na_action="ignore")):  # recordings of a length in one call
            for i, x in zip(same.index, resample(np.stack([np.asarray(x, np.float32) for x in same]), rate, target), strict=True):
                out[i] = x
        return out

    return convert(samples)


def trimmed(samples: Column, rate: int = RATE, trigger: float = TRIGGER) -> Column:
    """Arrays of samples without the silence before them."""

    @F.pandas_udf("array<float>")
    def convert(chunk: pd.Series) -> pd.Series:
        return chunk.map(lambda x: trim_silence(np.asarray(x, np.float32), rate, trigger))

    return convert(samples)
