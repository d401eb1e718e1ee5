"""Structured Streaming: voice sessions with state, live upserts, timing sums."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessitura.operators.audio import Voice, VoiceParams

#: Milliseconds without frames after which a session ends.
IDLE_MS = 50_000
SIGNALS = "session string, signal_type string, signal_at double, late_frames bigint"
STATE = "speaking boolean, against int, volume double, clock double, last_seq bigint, late bigint"


def voice_sessions(frames: DataFrame, params: VoiceParams = VoiceParams()) -> DataFrame:
    """Signals of a stream of frames (session, seq, probability, volume, control).

    Frames of a micro-batch are taken in order of seq; those at or before the last one seen are late: counted, not
    used. A frame with control END, or IDLE_MS without frames, drops the session's state; a first frame makes it.
    """

    def run(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        speaking, against, volume, clock, last, late = state.get if state.exists else (False, 0, 0.0, 0.0, -1, 0)
        voice, out, ended = Voice(params, (speaking, against, volume, clock)), [], False
        for f in pd.concat(list(pdfs)).sort_values("seq").itertuples():
            if f.seq <= last:
                late += 1
                continue
            last = int(f.seq)
            if got := voice.feed(f.probability, f.volume):
                out.append((key[0], *got, late))
            ended |= f.control == "END"
        if ended:
            state.remove()
        else:
            state.update((*voice.state, last, late))
            state.setTimeoutDuration(IDLE_MS)
        yield pd.DataFrame(out, columns=["session", "signal_type", "signal_at", "late_frames"])

    return frames.groupBy("session").applyInPandasWithState(run, SIGNALS, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


def live_latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The newest row of each key so far, for output mode update."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), F.col(order)).alias("row")).select(key, "row.*")


def timing_sums(rows: DataFrame, stage: str, seconds: str) -> DataFrame:
    """Seconds of each stage so far; negative ones count as 0."""
    return rows.groupBy(stage).agg(F.sum(F.greatest(F.col(seconds), F.lit(0.0))).alias("total_sec"), F.count("*").alias("n"))


def activity_windows(rows: DataFrame, at: str, key: str, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Rows of each key in tumbling windows, late rows accepted within the watermark."""
    return rows.withWatermark(at, late).groupBy(F.window(at, width), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), key, "n")
