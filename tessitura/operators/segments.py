"""The segment pipeline: units fitted to speech, cleaned, gated and laid out as rows of the manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessitura.functions import align
from tessitura.functions import text as tx
from tessitura.operators import quality, regions


def segment_rows(units: DataFrame, speech: DataFrame, info: DataFrame, entity: str = "audio_id", unit: str = "unit_id", policy: str = "cover", most_wer: float | None = None, heard: str | None = None, slack_ms: int = 400, pad_ms: int = 100, least_ms: int = 300) -> DataFrame:
    """Rows of the manifest from units (entity, unit, s_ms, e_ms, text), speech regions (entity, r_s, r_e) and what is
    known of each recording (entity, video_id, title, source_url).

    Units are fitted to the regions they overlap; promotional, blocklisted and looping text becomes ''; a segment whose
    text is gone has transcript_status missing, else ready. The text gate gives quality_label, score and reasons; with
    most_wer, a word error rate against column ``heard`` over it sends the segment to review. Segments of a recording
    are numbered by their begin. Units under least_ms after fitting are left out; recordings without info keep NULLs.
    """
    fitted = regions.align_units(units, speech, entity, unit, policy, slack_ms, pad_ms, least_ms)
    rows = fitted.withColumn("_clean", tx.clean_transcript(F.col("text")))
    length = (F.col("end_ms") - F.col("begin_ms")) / 1000
    gate = quality.gate_text(F.col("_clean"), length)
    if most_wer is not None and heard:
        c = align.aligned(tx.tokens(tx.wer_form(F.col("_clean"))), tx.tokens(tx.wer_form(F.col(heard))))
        rows = rows.withColumn("_wer", align.wer(c))
        gate = quality.gate_wer(gate, F.col("_wer"), most_wer)
    n = F.row_number().over(Window.partitionBy(entity).orderBy("begin_ms", "end_ms", unit)) - 1
    rows = rows.withColumn("_g", gate).withColumn("_no", n).join(info.select(entity, "video_id", "title", "source_url"), entity, "left")
    name = F.concat(F.col(entity), F.lit("_"), F.lpad(F.col("_no").cast("string"), 5, "0"))
    return rows.select(
        entity,
        "video_id",
        name.alias("segment_id"),
        F.concat(F.lit("segments/"), F.col(entity), F.lit("/"), name, F.lit(".wav")).alias("segment_file"),
        F.concat(F.lit("segments/"), F.col(entity), F.lit("/"), name, F.lit(".txt")).alias("transcript_file"),
        F.round(F.col("begin_ms") / 1000, 3).alias("start_sec"),
        F.round(F.col("end_ms") / 1000, 3).alias("end_sec"),
        F.round(length, 3).alias("duration"),
        F.col("_clean").alias("text"),
        F.lit("vtt").alias("transcript_source"),
        F.when(F.col("_clean") == "", "missing").otherwise("ready").alias("transcript_status"),
        "vad_status",
        F.col("_g.label").alias("quality_label"),
        F.col("_g.score").alias("quality_score"),
        F.array_join("_g.reasons", ",").alias("quality_reasons"),
        "source_url",
        "title",
    )


def outputs(rows: DataFrame) -> dict[str, DataFrame]:
    """The four outputs of a run: labels, those missing a transcript, a summary an audio, and its counts in all."""
    no_text = F.col("transcript_status").isin("missing", "empty")
    per = rows.groupBy("audio_id").agg(F.count("*").alias("n_segments"), F.count_if(no_text).alias("n_missing"), F.round(F.sum("duration"), 3).alias("speech_sec"), F.max_by("transcript_status", "segment_id").alias("last_status"))
    total = per.agg(F.count("*").alias("n_audio"), F.sum("n_segments").alias("n_segments"), F.sum("n_missing").alias("n_missing"))
    return {"labels": rows, "missing": rows.filter(no_text), "summary": per, "totals": total}
