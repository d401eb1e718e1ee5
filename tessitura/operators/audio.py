"""WAV decoding, framing, energy metrics and the voice state machine. Signals stay whole in their row; frames are arrays."""

from __future__ import annotations

import io
import wave
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FRAME = 512
WAV = "struct<rate:int,channels:int,width:int,n_frames:int,samples:array<smallint>,error:string>"


def decode_wav(data: bytes | None, mono: bool = True, strict: bool = True, rate: int | None = None) -> dict:
    """Header and samples of a WAV file. Channels are averaged unless mono asks for one; what isn't 16 bits, or not of
    the rate asked for, is an error row; strict=False takes 8 bits as well."""
    empty = {"rate": None, "channels": None, "width": None, "n_frames": None, "samples": None, "error": None}
    try:
        with wave.open(io.BytesIO(data or b"")) as w:
            head = {"rate": w.getframerate(), "channels": w.getnchannels(), "width": w.getsampwidth(), "n_frames": w.getnframes()}
            raw = w.readframes(head["n_frames"])
    except (wave.Error, EOFError) as e:
        return empty | {"error": str(e) or "not a WAV file"}
    if (head["width"] != 2 and (strict or head["width"] != 1)) or (strict and mono and head["channels"] != 1):
        return empty | head | {"error": "expected mono 16-bit PCM" if mono else "expected 16-bit PCM"}
    if rate and head["rate"] != rate:
        return empty | head | {"error": f"expected {rate} Hz"}
    x = np.frombuffer(raw, "<i2") if head["width"] == 2 else (np.frombuffer(raw, "u1").astype(np.int16) - 128) << 8
    if head["channels"] > 1:
        x = np.round(x[: len(x) // head["channels"] * head["channels"]].reshape(-1, head["channels"]).mean(axis=1)).astype("<i2")
    return empty | head | {"samples": x}


def encode_wav(samples: list[int], rate: int) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.asarray(samples, "<i2").tobytes())
    return out.getvalue()


def with_wav(df: DataFrame, content: str, mono: bool = True, strict: bool = True, rate: int | None = None) -> DataFrame:
    """df with column wav: header, samples, or the error that a strict reader raises. Samples go as Arrow arrays."""

    def decode(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([decode_wav(b, mono, strict, rate) for b in s], columns=["rate", "channels", "width", "n_frames", "samples", "error"], dtype=object)

    decode.__annotations__ = {"s": pd.Series, "return": pd.DataFrame}
    return df.withColumn("wav", F.pandas_udf(decode, WAV)(F.col(content)))


def as_float(samples):
    """16-bit samples as numbers in [-1, 1)."""
    return F.transform(samples, lambda x: x / F.lit(32768.0))


def is_clean(wav, rate: int):
    """Whether a decoded header is mono, 16 bits, of the expected rate."""
    return F.coalesce((wav["channels"] == 1) & (wav["width"] == 2) & (wav["rate"] == rate), F.lit(False))


def cut(samples, rate, start, end):
    """Samples from start to end seconds, bounds rounded half to even and clamped to the signal."""
    a = F.least(F.greatest(F.bround(start * rate).cast("int"), F.lit(0)), F.size(samples))
    b = F.least(F.greatest(F.bround(end * rate).cast("int"), a), F.size(samples))
    return F.slice(samples, a + 1, b - a)


def frames(signal, size: int = FRAME):
    """Consecutive frames, the last filled up with zeros; [] for an empty signal."""
    n = F.ceil(F.size(signal) / size).cast("int")
    one = lambda i: F.concat(F.slice(signal, i * size + 1, size), F.array_repeat(F.lit(0.0), F.greatest(F.lit(0), size - (F.size(signal) - i * size))))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), one)).otherwise(F.array().cast("array<array<double>>"))


def rms(frame):
    return F.sqrt(F.aggregate(frame, F.lit(0.0), lambda a, x: a + x * x) / F.greatest(F.size(frame), F.lit(1)))


def peak(frame):
    return F.coalesce(F.array_max(F.transform(frame, lambda x: F.abs(x))), F.lit(0.0))


def metrics(chunks, threshold: float = 0.015):
    """struct(rms, peak, active_ratio) of a signal's chunks: mean rms, highest peak, share of chunks at the threshold."""
    levels = F.transform(chunks, rms)
    n = F.greatest(F.size(chunks), F.lit(1))
    return F.struct(
        (F.aggregate(levels, F.lit(0.0), lambda a, x: a + x) / n).alias("rms"),
        F.coalesce(F.array_max(F.transform(chunks, peak)), F.lit(0.0)).alias("peak"),
        (F.size(F.filter(levels, lambda x: x >= threshold)) / n).alias("active_ratio"),
    )


def energy_mask(chunks, below_db: float = 35.0, least: float = 0.0001):
    """Whether each chunk's rms is within below_db of the loudest chunk and at least ``least``."""
    levels = F.transform(chunks, rms)
    floor = F.greatest(F.lit(least), F.array_max(levels) * 10 ** (-below_db / 20))
    return F.transform(levels, lambda x: x >= floor)


@dataclass(frozen=True)
class VoiceParams:
    """Thresholds of the voice state machine."""

    confidence: float = 0.7
    min_volume: float = 0.6
    start_secs: float = 0.1
    stop_secs: float = 0.45
    negative_confidence: float | None = None
    frame_ms: int = 32
    smoothing: float = 0.2
    soft: bool = False
    soft_start: tuple[float, float, float] = (0.8, 0.8, 1.9)
    soft_continue: tuple[float, float, float] = (0.7, 0.7, 1.7)


class Voice:
    """Quiet or speaking, with so many frames needed to change over; fed frame by frame."""

    def __init__(self, p: VoiceParams, state: tuple[bool, int, float, float] = (False, 0, 0.0, 0.0)):
        self.p = p
        self.speaking, self.against, self.volume, self.clock = state
        self.need = {False: round(p.start_secs * 1000 / p.frame_ms), True: round(p.stop_secs * 1000 / p.frame_ms)}

    @property
    def state(self) -> tuple[bool, int, float, float]:
        return self.speaking, self.against, self.volume, self.clock

    def _heard(self, probability: float) -> bool:
        p = self.p
        low = p.confidence
        if self.speaking:
            low = max(p.confidence - 0.15, 0.01) if p.negative_confidence is None else p.negative_confidence
        if probability >= low and self.volume >= p.min_volume:
            return True
        if not p.soft:
            return False
        of_p, of_v, score = p.soft_continue if self.speaking else p.soft_start
        parts = probability / max(low, 0.01) + self.volume / max(p.min_volume, 0.01)
        return probability >= low * of_p and self.volume >= p.min_volume * of_v and parts >= score

    def feed(self, probability: float, volume: float) -> tuple[str, float] | None:
        """The signal that this frame sets off, dated back by the frames it took."""
        self.clock += self.p.frame_ms / 1000
        self.volume += self.p.smoothing * (volume - self.volume)
        # one frame of the present state undoes what spoke against it
        self.against = self.against + 1 if self._heard(probability) != self.speaking else 0
        if not self.against or self.against < self.need[self.speaking]:
            return None
        self.speaking, self.against = not self.speaking, 0
        back = self.p.start_secs if self.speaking else self.p.stop_secs
        return ("SPEAKING" if self.speaking else "QUIET"), max(self.clock - back, 0.0)


def voice_signals(df: DataFrame, entity: str, order: str, probability: str, volume: str, params: VoiceParams = VoiceParams()) -> DataFrame:
    """(entity, seq, signal_type, signal_at) of each recording's frames in order; frames of equal order go by probability,
    then volume, those of NULL order last. A recording lies in one partition, but only its state is held: its frames
    stream through in batches, so that it may have any length. NULL counts as 0, as does NaN, of which nothing is heard.
    """
    kind = dict(df.dtypes)[entity]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, voice, seq = None, None, 0
        for b in batches:
            e, p, x = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()
            at, out = [], []
            for i, k in enumerate(e):
                if voice is None or k != now:
                    now, voice, seq = k, Voice(params), 0
                if s := voice.feed(p[i], x[i]):
                    at.append(i)
                    out.append((seq, *s))
                    seq += 1
            n, kinds, times = zip(*out) if out else ((), (), ())
            yield pa.record_batch([b.column(0).take(pa.array(at, pa.int64())), pa.array(n, pa.int32()), pa.array(kinds, pa.string()), pa.array(times, pa.float64())], ["k", "seq", "signal_type", "signal_at"])

    level = lambda c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0))
    rows = df.filter(F.col(entity).isNotNull()).select(F.col(entity).alias("k"), level(probability).alias("p"), level(volume).alias("v"), F.col(order).alias("o"))
    rows = rows.repartition("k").sortWithinPartitions("k", F.asc_nulls_last("o"), "p", "v").select("k", "p", "v")
    return rows.mapInArrow(part, f"k {kind}, seq int, signal_type string, signal_at double").withColumnRenamed("k", entity)


def augment(signals: Iterator[pd.DataFrame], column: str, key: str, seed: int = 42, snr_db: float = 20.0, gain_db: float = 3.0, noise_p: float = 0.2) -> Iterator[pd.DataFrame]:
    """For mapInPandas: gain within ±gain_db and, with probability noise_p, noise at snr_db, drawn from the row's key and
    the seed."""
    for pdf in signals:
        out = []
        for k, x in zip(pdf[key], pdf[column]):
            rng = np.random.default_rng([seed, zlib.crc32(str(k).encode())])
            y = np.asarray(x, float) * 10 ** (rng.uniform(-gain_db, gain_db) / 20)
            power = float(np.mean(y**2)) / 10 ** (snr_db / 10) if len(y) and rng.random() < noise_p else 0.0
            out.append(np.clip(y + rng.normal(0, np.sqrt(power), len(y)), -1, 1).tolist())
        yield pdf.assign(**{column: out})
