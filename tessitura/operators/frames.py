"""Frames of signals: labels from regions and from energy, energy-refined regions, loudness, datasets and their splits.

Frames are numbered from 0 and last frame_ms each; times are integer milliseconds unless said otherwise.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessitura.operators.audio import frames
from tessitura.operators.regions import merge_speech, overlaps
from tessitura.runtime import cut


def labelled_frames(lengths: DataFrame, regions: DataFrame, entity: str, n_frames: str, start: str, end: str, frame_ms: int = 32, least: float = 0.5) -> DataFrame:
    """(entity, frame_idx, label): label 1 where any single region covers ``least`` of the frame.

    Frames go in blocks of 64, a region's to those that it touches: what meets is a block's mask of covered frames, so
    nothing is compared with all frames of a recording, and neither an array nor a shuffle has a row a frame. Entities
    without regions have label 0 everywhere; NULL, reversed and empty regions cover nothing. All numbers are longs.
    """
    n = F.col(n_frames).cast("bigint")
    upto = lambda k: F.floor((k - 1) / 64)
    blocks = lengths.filter(n > 0).select(entity, n.alias("_n"), F.explode(F.sequence(F.lit(0).cast("bigint"), upto(n))).alias("_block"))
    ok = (F.col(end) > F.col(start)) & (F.col(end) > 0)
    first, last = F.greatest(F.lit(0).cast("bigint"), F.floor(F.col(start) / frame_ms)), F.floor((F.col(end) - 1) / frame_ms)
    met = regions.filter(ok).select(entity, start, end, first.alias("_a"), last.alias("_z"))
    met = met.select("*", F.explode(F.sequence(F.floor(F.col("_a") / 64), F.floor(F.col("_z") / 64))).alias("_block"))
    inside = F.sequence(F.greatest(F.col("_a"), F.col("_block") * 64), F.least(F.col("_z"), F.col("_block") * 64 + 63))
    covered = lambda i: F.least(F.col(end), (i + 1) * frame_ms) - F.greatest(F.col(start), i * frame_ms)
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(i, F.lit(64)).cast("int"))
    mask = F.aggregate(F.filter(inside, lambda i: covered(i) >= least * frame_ms), F.lit(0).cast("bigint"), lambda m, i: m.bitwiseOR(bit(i)))
    hit = met.select(entity, "_block", mask.alias("_m")).filter("_m <> 0").groupBy(entity, "_block").agg(F.bit_or("_m").alias("_m"))
    each = F.sequence(F.col("_block") * 64, F.least(F.col("_n") - 1, F.col("_block") * 64 + 63))
    out = blocks.join(hit, [entity, "_block"], "left").select(entity, "_m", F.explode(each).alias("frame_idx"))
    return out.select(entity, "frame_idx", F.when(F.col("_m").bitwiseAND(bit(F.col("frame_idx"))) != 0, 1).otherwise(0).alias("label"))


def region_frames(signals: DataFrame, regions: DataFrame, entity: str, signal: str, rate: int, label: int, size: int = 512) -> DataFrame:
    """(entity, start_at, frame_idx, frame, label): frames of the parts of a signal inside regions (columns start, end in
    seconds, rounded half to even to samples); parts under one frame are left out."""
    a = F.greatest(F.lit(0), F.bround(F.col("start") * rate).cast("int"))
    b = F.least(F.size(signal), F.bround(F.col("end") * rate).cast("int"))
    j = signals.select(entity, signal).join(regions.select(entity, "start", "end"), entity).withColumns({"start_at": a, "_b": b}).filter(F.col("_b") - F.col("start_at") >= size)
    part = F.slice(signal, F.col("start_at") + 1, F.col("_b") - F.col("start_at"))
    return j.select(entity, "start_at", F.posexplode(frames(part, size)).alias("frame_idx", "frame")).withColumn("label", F.lit(label))


def all_speech(df: DataFrame, entity: str, signal: str, size: int = 512) -> DataFrame:
    """(entity, frame_idx, frame, label): every frame of a recording of speech, labelled 1."""
    return df.select(entity, F.posexplode(frames(F.col(signal), size)).alias("frame_idx", "frame")).withColumn("label", F.lit(1))


def energy_regions(levels: DataFrame, entity: str, frame: str, rms: str, frame_ms: int = 32, below_db: float = 35.0, least: float = 0.0001, gap_ms: int = 96, shortest_ms: int = 96, pad_ms: int = 64) -> DataFrame:
    """(entity, begin_ms, end_ms): runs of loud frames, with short gaps filled, short runs dropped and the whole span from
    the first to the last loud frame padded (one hull).

    Loud is what reaches ``least`` and lies within below_db of the entity's loudest frame. Runs go through dyadic cells,
    so that a recording of any length is spread.
    """
    peak = levels.groupBy(entity).agg(F.max(rms).alias("_peak"))
    loud = levels.join(peak, entity).filter((F.col("_peak") > 0) & (F.col(rms) >= F.greatest(F.lit(least), F.col("_peak") * 10 ** (-below_db / 20))))
    runs = loud.select(entity, (F.col(frame) * frame_ms).cast("bigint").alias("_a"), ((F.col(frame) + 1) * frame_ms).cast("bigint").alias("_b"))
    runs = merge_speech(runs, [entity], "_a", "_b", round(gap_ms / frame_ms) * frame_ms, 0).filter(F.col("end_ms") - F.col("begin_ms") >= round(shortest_ms / frame_ms) * frame_ms)
    pad = round(pad_ms / frame_ms) * frame_ms
    return runs.groupBy(entity).agg(F.greatest(F.lit(0), F.min("begin_ms") - pad).cast("bigint").alias("begin_ms"), (F.max("end_ms") + pad).cast("bigint").alias("end_ms"))


def refined(rough: DataFrame, loud: DataFrame, entity: str, key: str, search_ms: int = 700, gap_ms: int = 200, least_ms: int = 250) -> DataFrame:
    """(entity, begin_ms, end_ms): rough regions (key, s_ms, e_ms) moved to the loud ones (r_s, r_e) that they overlap or,
    where there are none, to those within search_ms; regions near none go. Then merged.

    One overlap join within the search range serves both: whether a pair overlaps the region itself decides which counts.
    """
    wide = rough.select(entity, key, "s_ms", "e_ms", F.greatest(F.lit(0), F.col("s_ms") - search_ms).cast("bigint").alias("_a"), (F.col("e_ms") + search_ms).cast("bigint").alias("_b"))
    met = overlaps(wide, loud.select(entity, "r_s", "r_e"), entity, ("_a", "_b"), ("r_s", "r_e"))
    direct = (F.col("r_s") < F.col("e_ms")) & (F.col("s_ms") < F.col("r_e"))
    pick = lambda f, c: F.coalesce(f(F.when(direct, F.col(c))), f(c))
    hull = met.groupBy(entity, key).agg(pick(F.min, "r_s").alias("_a"), pick(F.max, "r_e").alias("_b"))
    return merge_speech(cut(hull), [entity], "_a", "_b", gap_ms, least_ms)  # kept, as merging looks for long regions first


def _biquad(x: np.ndarray, b: tuple, a: tuple) -> np.ndarray:
    """A second-order filter by its impulse response, which both filters here let fade within a second."""
    n = len(x)
    h = np.zeros(max(1, min(n, 16_000)))
    y1 = y2 = x1 = x2 = 0.0
    for i in range(len(h)):
        x0 = 1.0 if i == 0 else 0.0
        h[i] = b[0] * x0 + b[1] * x1 + b[2] * x2 - a[1] * y1 - a[2] * y2
        x2, x1, y2, y1 = x1, x0, y1, h[i]
    size = 1 << (n + len(h)).bit_length()
    return np.fft.irfft(np.fft.rfft(x, size) * np.fft.rfft(h, size), size)[:n]


def _k_weights(rate: int) -> list[tuple[tuple, tuple]]:
    """The two filters of loudness by ITU-R BS.1770: a high shelf (4 dB, 1500 Hz) and a high pass (38 Hz)."""
    out = []
    for kind, gain, q, f in (("shelf", 4.0, 0.7071752369554196, 1500.0), ("pass", 0.0, 0.5, 38.0)):
        w, amp = 2 * np.pi * f / rate, 10 ** (gain / 40)
        al, c = np.sin(w) / (2 * q), np.cos(w)
        if kind == "shelf":
            r = 2 * np.sqrt(amp) * al
            b = (amp * ((amp + 1) + (amp - 1) * c + r), -2 * amp * ((amp - 1) + (amp + 1) * c), amp * ((amp + 1) + (amp - 1) * c - r))
            a = ((amp + 1) - (amp - 1) * c + r, 2 * ((amp - 1) - (amp + 1) * c), (amp + 1) - (amp - 1) * c - r)
        else:
            b, a = ((1 + c) / 2, -(1 + c), (1 + c) / 2), (1 + al, -2 * c, 1 - al)
        out.append((tuple(x / a[0] for x in b), tuple(x / a[0] for x in a)))
    return out


def loudness(x: np.ndarray, rate: int) -> float:
    """Integrated loudness of one block as long as the signal, in dB; -inf for silence and an empty signal."""
    y = np.asarray(x, float)
    for b, a in _k_weights(rate):
        y = _biquad(y, b, a)
    power = float(np.mean(y**2)) if len(y) else 0.0
    level = -0.691 + 10 * np.log10(power) if power > 0 else -np.inf
    return level if level >= -70 else -np.inf


def volume(samples: Column, rate: int) -> Column:
    """Loudness of a chunk, from -20..80 to 0..1."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: float(np.clip((loudness(x, rate) + 20) / 100, 0, 1)) if x is not None else None)

    run.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "double")(samples)


def smoothed(volumes: DataFrame, entity: str, order: str, value: str, factor: float = 0.2, back: int = 64) -> DataFrame:
    """df with column smoothed: each volume mixed into the one before by ``factor``. What lies more than ``back`` rows back
    weighs under factor * (1 - factor)**back and is passed over, so that a window has a fixed length."""
    w = Window.partitionBy(entity).orderBy(order).rowsBetween(-back, 0)
    past = F.collect_list(F.coalesce(value, F.lit(0.0))).over(w)
    return volumes.withColumn("smoothed", F.aggregate(past, F.lit(0.0), lambda acc, x: acc + factor * (x - acc)))


def with_source(parts: dict[str, DataFrame]) -> DataFrame:
    """All rows of all parts, with their name in column source; a part's missing columns are NULL."""
    out = None
    for name, df in parts.items():
        one = df.drop("source").withColumn("source", F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def shuffle_split(df: DataFrame, key: str, share: float, seed: int = 42) -> DataFrame:
    """df with split: val for the ``share`` of rows of the least seeded hashes, else train. Needs no order of all rows:
    the bound is a quantile of the uniform hash."""
    u = F.shiftrightunsigned(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), 11) / F.lit(float(1 << 53))
    return df.withColumn("split", F.when(u < share, "val").otherwise("train"))


def drawn(df: DataFrame, key: str, weight: Column, n: int, total: float, seed: int = 42) -> DataFrame:
    """df with draws: how often each row comes in about n weighted draws with replacement (an inverse Poisson of
    n * weight / total at a number hashed from the key); rows not drawn go. total is the sum of all weights."""
    u = F.shiftrightunsigned(F.xxhash64(F.col(key).cast("string"), F.lit(seed), F.lit("draw")), 11) / F.lit(float(1 << 53))
    mean = F.greatest(F.lit(0.0), weight.cast("double")) * n / total
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.lit(0).alias("k"))
    step = lambda s, i: F.when(s["c"] <= u, F.struct((s["p"] * mean / i).alias("p"), (s["c"] + s["p"] * mean / i).alias("c"), (s["k"] + 1).alias("k"))).otherwise(s)
    steps = F.sequence(F.lit(1), F.ceil(mean + 10 * F.sqrt(mean) + 10).cast("int"))
    return df.withColumn("draws", F.aggregate(steps, start, step, lambda s: s["k"])).filter(F.col("draws") > 0)
