"""The segment manifest: upsert that keeps human review, review view and summaries, per-audio summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessitura.runtime import blank_to_null

REVIEW = ("reference", "manual_wer", "review_status")


def upsert(old: DataFrame, new: DataFrame, key: str, kept: tuple[str, ...] = REVIEW) -> DataFrame:
    """Rows of both by key: new values win, but review columns of old stay where they hold something; a segment for
    review without a state is pending; rows that only old has stay. Keys must be distinct on either side."""
    o, n = old.alias("o"), new.alias("n")
    j = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    is_new = F.col(f"n.{key}").isNotNull()

    def pick(c: str):
        a, b = F.col(f"o.{c}"), F.col(f"n.{c}")
        if c == key:
            return F.coalesce(b, a).alias(c)
        if c in kept:
            held = blank_to_null(a) if dict(old.dtypes)[c] == "string" else F.when(~F.isnan(a), a) if dict(old.dtypes)[c] == "double" else a
            return F.coalesce(held, b).alias(c)
        return F.when(is_new, b).otherwise(a).alias(c)

    out = j.select(*[pick(c) for c in new.columns])
    pending = (F.col("quality_label") == "needs_review") & (F.coalesce(F.trim("review_status"), F.lit("")) == "")
    return out.withColumn("review_status", F.when(pending, "pending").otherwise(F.col("review_status")))


def review_view(df: DataFrame, label: str = "needs_review") -> DataFrame:
    """What a reviewer sees of the segments of a label."""
    ref, hyp = (F.coalesce(F.trim(c), F.lit("")) for c in ("reference", "text"))
    return df.filter(F.col("quality_label") == label).select(
        "segment_id", "start_sec", "end_sec", "text", F.coalesce("reference", F.lit("")).alias("reference"), F.when(F.isnan("manual_wer"), None).otherwise(F.col("manual_wer")).alias("manual_wer"),
        F.coalesce(blank_to_null(F.col("review_status")), F.lit("pending")).alias("review_status"), ((ref == "") & (hyp != "")).alias("spurious"),
    )


def split_reasons(df: DataFrame, column: str = "quality_reasons") -> DataFrame:
    """A row per reason of the comma-joined list; '' and NULL have none."""
    parts = F.filter(F.split(F.coalesce(F.col(column), F.lit("")), ","), lambda x: F.trim(x) != "")
    return df.withColumn("reason", F.explode(F.transform(parts, lambda x: F.trim(x))))


def audio_summary(parts: dict[str, DataFrame], entity: str, text: str = "text") -> DataFrame:
    """Per entity the rows of each part, and those with text; one exchange of partial counts for all parts."""
    rows = None
    for name, df in parts.items():
        has = (F.coalesce(F.trim(text), F.lit("")) != "").cast("long") if text in df.columns else F.lit(0).cast("long")
        one = df.filter(F.col(entity).isNotNull()).groupBy(entity).agg(F.count("*").alias("n"), F.sum(has).alias("t")).withColumn("part", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    agg = []
    for name, df in parts.items():
        agg.append(F.sum(F.when(F.col("part") == name, F.col("n")).otherwise(0)).alias(f"n_{name}"))
        if text in df.columns:
            agg.append(F.sum(F.when(F.col("part") == name, F.col("t")).otherwise(0)).alias(f"n_{name}_with_text"))
    return rows.groupBy(entity).agg(*agg)


def validation(df: DataFrame, length: str) -> DataFrame:
    """Counts and extremes of segment lengths."""
    d = F.when(~F.isnan(length), F.col(length))
    return df.select(d.alias("d")).agg(F.count("*").alias("n"), F.count("d").alias("n_timed"), F.min("d").alias("min_sec"), F.round(F.avg("d"), 6).alias("avg_sec"), F.max("d").alias("max_sec"), F.count_if(F.col("d") < 0.3).alias("n_short"), F.count_if(F.col("d") > 12).alias("n_long"))
