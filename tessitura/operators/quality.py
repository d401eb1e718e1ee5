"""Quality gates of audio and text as CASE arithmetic over columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessitura.functions.text import tokens


def _reasons(*pairs: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(c, r) for c, r in pairs]))


def _decision(score: Column, reasons: Column) -> Column:
    """struct(keep, label, score, reasons); the score is compared before it is rounded."""
    keep = score >= 0.5
    label = F.when(F.size(reasons) == 0, "speech_clean").when(keep, "needs_review").otherwise("low_quality")
    return F.struct(keep.alias("keep"), label.alias("label"), F.greatest(F.lit(0.0), F.round(score, 3)).alias("score"), reasons.alias("reasons"))


def gate_audio(rms: Column, peak: Column, active: Column, min_rms: float = 0.015, min_peak: float = 0.05, min_active: float = 0.35) -> Column:
    low = [(rms < min_rms, "low_rms", 0.45), (peak < min_peak, "low_peak", 0.25), (active < min_active, "low_active_ratio", 0.45)]
    score = F.lit(1.0)
    for c, _, points in low:
        score = score - F.when(c, points).otherwise(0.0)
    return _decision(score, _reasons(*[(c, r) for c, r, _ in low]))


def gate_text(text: Column, duration: Column, least: float = 0.6, most: float = 6.0, long_sec: float = 2.5, few: int = 2) -> Column:
    """As gate_audio, on the words a second; blank text is kept out with reason empty_transcript."""
    n = F.size(tokens(text))
    rate = n / F.greatest(duration, F.lit(1e-6))
    rules = [((duration >= long_sec) & (n < few), "too_few_tokens_for_duration", 0.6), (rate < least, "low_token_density", 0.35), (rate > most, "high_token_density", 0.35)]
    score = F.lit(1.0)
    for c, _, points in rules:
        score = score - F.when(c, points).otherwise(0.0)
    full = _decision(score, _reasons(*[(c, r) for c, r, _ in rules]))
    empty = F.struct(F.lit(False).alias("keep"), F.lit("low_quality").alias("label"), F.lit(0.0).alias("score"), F.array(F.lit("empty_transcript")).alias("reasons"))
    return F.when(n == 0, empty).otherwise(full)


def merged(a: Column, b: Column) -> Column:
    """Both decisions: kept by both, the lower score, all reasons once."""
    reasons = F.array_distinct(F.concat(a["reasons"], b["reasons"]))
    score = F.least(a["score"], b["score"])
    keep = a["keep"] & b["keep"]
    label = F.when(F.size(reasons) == 0, "speech_clean").when(keep & (score >= 0.5), "needs_review").otherwise("low_quality")
    return F.struct(keep.alias("keep"), label.alias("label"), score.alias("score"), reasons.alias("reasons"))


def gate_wer(decision: Column, wer: Column, most: float) -> Column:
    """A word error rate over ``most`` sends a segment to review with a lower score; its text stays."""
    over = F.coalesce(wer > most, F.lit(False))
    reason = F.lit(f"wer_gate>{most}")
    flagged = F.struct(
        F.lit(False).alias("keep"),
        F.lit("needs_review").alias("label"),
        F.least(decision["score"], 1 - F.least(wer, F.lit(1.0))).alias("score"),
        F.array_append(decision["reasons"], reason).alias("reasons"),
    )
    return F.when(over, flagged).otherwise(decision)
