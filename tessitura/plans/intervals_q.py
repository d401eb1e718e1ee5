"""Queries of problem 3: periods and gaps of speech regions and caption cues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessitura.operators.dyadic import interval_gaps, merge_intervals, to_ms
from tessitura.runtime import table

BREAK_MS = 600_000


def both_tables(spark: SparkSession, d: str) -> DataFrame:
    def one(src: str, name: str) -> DataFrame:
        t = table(spark, d, name).filter(F.col("end_sec") > F.col("start_sec"))
        return t.select(F.lit(src).alias("src"), "audio_id", to_ms(F.col("start_sec")).alias("s_ms"), to_ms(F.col("end_sec")).alias("e_ms"))

    return one("region", "speech_regions").unionByName(one("cue", "transcript_cues"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return interval_gaps(both_tables(spark, d), ["src", "audio_id"], "s_ms", "e_ms", BREAK_MS)


def p3_periods(spark: SparkSession, d: str) -> DataFrame:
    return merge_intervals(both_tables(spark, d), ["src", "audio_id"], "s_ms", "e_ms").select(
        "src", "audio_id", "begin_ms", "end_ms"
    )


_ROWS = """
WITH r AS (
  SELECT 'region' AS src, audio_id, start_sec, end_sec FROM speech_regions
  UNION ALL SELECT 'cue', audio_id, start_sec, end_sec FROM transcript_cues),
i AS (
  SELECT DISTINCT src, audio_id, CAST(round(start_sec * 1000) AS BIGINT) AS s, CAST(round(end_sec * 1000) AS BIGINT) AS e
  FROM r WHERE end_sec > start_sec AND audio_id IS NOT NULL),
m AS (SELECT *, max(e) OVER (PARTITION BY src, audio_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM i WHERE e > s)
"""
SQL = {
    "p3_found": _ROWS + "SELECT src, audio_id, pe AS gap_start_ms, s AS gap_end_ms FROM m WHERE s > pe AND s - pe < 600000",
    "p3_periods": _ROWS
    + """, g AS (SELECT *, sum(CASE WHEN pe IS NULL OR s > pe THEN 1 ELSE 0 END) OVER (PARTITION BY src, audio_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM m)
SELECT src, audio_id, min(s) AS begin_ms, max(e) AS end_ms FROM g GROUP BY src, audio_id, k""",
}
QUERIES = {"p3_found": p3_found, "p3_periods": p3_periods}
