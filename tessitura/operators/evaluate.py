"""Word and character error rates: by segment, document, source; review summaries; detection metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessitura.functions import align
from tessitura.functions.text import tokens, wer_form


def scored(df: DataFrame, ref: str, hyp: str, level: str = "normalized", windowed: bool = False) -> DataFrame:
    """df with counts (S, D, I, C, n_ref, n_hyp), wer and flag: spurious, no_ref or ''."""
    c = F.col("counts")
    out = df.withColumn("counts", align.aligned(tokens(wer_form(F.col(ref), level)), tokens(wer_form(F.col(hyp), level)), windowed))
    flag = F.when(align.is_spurious(c), "spurious").when(c["n_ref"] == 0, "no_ref").otherwise("")
    return out.withColumn("wer", align.wer(c)).withColumn("flag", flag)


def micro(c: Column) -> Column:
    """Micro-average of counts: all errors over all reference words, of rows with a reference; NULL if there is none."""
    has = c["n_ref"] > 0
    return F.try_divide(F.sum(F.when(has, align.errors(c))), F.sum(F.when(has, c["n_ref"])))


def summary(df: DataFrame, by: list[str]) -> DataFrame:
    """Per group: scored and spurious segments, S/D/I, wholly wrong segments, micro and macro rates, exact, bad."""
    c = F.col("counts")
    has = c["n_ref"] > 0
    return df.groupBy(*by).agg(
        F.count_if(has).alias("n_scored"),
        F.sum(F.when(has, c["sub"]).otherwise(0)).alias("n_sub"),
        F.sum(F.when(has, c["del"]).otherwise(0)).alias("n_del"),
        F.sum(F.when(has, c["ins"]).otherwise(0)).alias("n_ins"),
        F.count_if((c["n_ref"] >= 3) & (c["cor"] == 0)).alias("total_miss"),
        F.count_if(align.is_spurious(c)).alias("n_spurious"),
        F.coalesce(F.sum(F.when(align.is_spurious(c), c["ins"])), F.lit(0)).alias("spurious_tokens"),
        F.round(micro(c), 6).alias("micro_wer"),
        F.round(F.avg("wer"), 6).alias("macro_wer"),
        F.count_if(F.col("wer") == 0).alias("n_exact"),
        F.count_if(F.col("wer") >= 0.5).alias("n_bad"),
    )


def worst(df: DataFrame, by: str, tie: str, n: int = 3) -> DataFrame:
    """The n rows of each group with most errors, none without; ties by ``tie``. Top-k is the feature here."""
    w = Window.partitionBy(by).orderBy(F.desc("n_errors"), tie)
    return df.withColumn("n_errors", align.errors(F.col("counts"))).filter("n_errors > 0").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def verdict(wer: Column) -> Column:
    return F.when(wer.isNull(), "no reference").when(wer <= 0.15, "good").when(wer <= 0.35, "usable after review").when(wer <= 0.5, "poor").otherwise("unusable")


def label_quality(df: DataFrame, text: str, wer: str, by: list[str], bad_over: float = 0.5) -> DataFrame:
    """Of labels whose text isn't blank: usable, wrong, precision of the usable."""
    usable = F.coalesce(F.trim(F.col(text)), F.lit("")) != ""
    right = usable & (F.col(wer) <= bad_over)
    return df.groupBy(*by).agg(F.count_if(usable).alias("usable"), F.count_if(usable & (F.col(wer) > bad_over)).alias("mislabelled"), F.try_divide(F.count_if(right), F.count_if(usable)).alias("precision"))


def ranking(df: DataFrame, score: str, label: str, threshold: float, buckets: int = 4096, span: tuple[float, float] = (0.0, 1.0)) -> DataFrame:
    """Detection rate, false alarms, AUC and average precision of a score in [span]; ties of a bucket count half.

    Scores are counted in ``buckets`` steps first, so that ranking needs no global sort.
    """
    lo, hi = span
    b = F.least(F.lit(buckets - 1), F.greatest(F.lit(0), F.floor((F.col(score) - lo) / (hi - lo) * buckets)))
    counts = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(b.alias("b")).agg(
        F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"), F.count_if((F.col(label) == 1) & (F.col(score) >= threshold)).alias("hit"), F.count_if((F.col(label) == 0) & (F.col(score) >= threshold)).alias("alarm")
    )
    w = Window.orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, 0)
    down = counts.withColumn("tp", F.sum("p").over(w)).withColumn("fp", F.sum("n").over(w))
    return down.agg(
        F.try_divide(F.sum("hit"), F.sum("p")).alias("detection"),
        F.try_divide(F.sum("alarm"), F.sum("n")).alias("false_alarm"),
        F.try_divide(F.sum(F.col("n") * (F.col("tp") - F.col("p") / 2)), F.sum("p") * F.sum("n")).alias("auc"),
        F.try_divide(F.sum(F.col("p") * F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))), F.sum("p")).alias("average_precision"),
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """n / (classes * n_class) of each class."""
    c = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    w = Window.partitionBy()
    return c.withColumn("weight", F.sum("n").over(w) / (F.count("*").over(w) * F.col("n")))
