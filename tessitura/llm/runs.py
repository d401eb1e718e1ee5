"""Runs of repeated consecutive events, collapsed with their count and duration.

Events are canonicalised so that near-identical neighbours share a value; a run is then what has one value and one
difference between the row number within the entity and the row number within entity and value. Entities are cut into
blocks of positions, as wide as BLOCK events of the largest entity take, so that an entity of any size is spread over
tasks, however sparse its positions; runs that touch a block's border are joined afterwards from at most two rows a
block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessitura.functions.text import nfc

BLOCK = 4096


def composed(text: Column) -> Column:
    """Text in composed form; only texts with combining accents leave the JVM."""
    return F.coalesce(nfc(F.when(text.rlike("[\u0300-\u036f\u0591-\u06ed\u3099\u309a\u1100-\u11ff]"), text)), text)


def spoken_key(text: Column) -> Column:
    """What a caption says: letters, marks and digits in lower case, without markup, punctuation, symbols and spacing.

    Numbers stay apart from one another. NULL where there is no word.
    """
    plain = F.regexp_replace(text, r"<[^<>]*>", "")
    plain = F.regexp_replace(plain, r"(?<=\p{N})[^\p{L}\p{M}\p{N}]+(?=\p{N})", "\u0001")
    plain = F.regexp_replace(plain, r"[^\p{L}\p{M}\p{N}\x01]+", "")
    plain = F.lower(plain)
    return F.when(F.length(plain) > 0, plain)


def _numbers(key: Column) -> Column:
    return F.regexp_extract_all(key, F.lit(r"(\p{N}+)"), 1)


def same_but_slip(a: Column, b: Column) -> Column:
    """Whether two keys are equal or one slip apart (a letter missing, added, replaced, or two neighbours swapped)."""
    near = F.levenshtein(a, b, 2)
    swapped = F.exists(
        F.sequence(F.lit(1), F.length(a) - 1),
        lambda i: F.concat(a.substr(F.lit(1), i - 1), a.substr(i + 1, F.lit(1)), a.substr(i, F.lit(1)), a.substr(i + 2, F.length(a))) == b,
    )
    one = F.when(near == 1, F.lit(True)).when((near == 2) & (F.length(a) == F.length(b)) & (F.length(a) > 1), swapped).otherwise(False)
    close = F.abs(F.length(a) - F.length(b)) <= 1
    return F.coalesce(F.when(a == b, True).when(close, F.when(one, _numbers(a) == _numbers(b)).otherwise(False)), F.lit(False))


def collapse_runs(df: DataFrame, entity: str, position: str, text: str, start: str, end: str, latest: list[str], min_count: int = 1) -> DataFrame:
    """One row a run: entity, first_idx, last_idx, n_events, text, start, end, duration.

    position orders the events of an entity (int or bigint); of rows with the same entity and position the one with the
    highest ``latest`` columns counts. Events without words belong to no run and end one; they give no row. Rows with
    a NULL entity or position are ignored; start is the earliest and end the latest of the run, NULLs passed over, and
    the duration is NULL where either is missing. Empty input gives no rows; other columns are ignored.
    """
    placed = df.filter(F.col(entity).isNotNull() & F.col(position).isNotNull())
    spread = placed.groupBy(entity).agg(F.count("*").alias("n"), (F.max(F.col(position).cast("double")) - F.min(F.col(position).cast("double"))).alias("width"))
    apart = spread.agg(F.max_by(F.col("width") / F.col("n"), "n")).head()[0]  # between events of the largest entity
    block = F.floor(F.col(position) / (BLOCK * max(1, round(apart or 1))))
    last = F.max_by(F.struct(F.col(text).alias("t"), F.col(start).alias("s"), F.col(end).alias("e")), F.struct(*[F.col(c) for c in latest]))
    events = (
        placed.select(F.col(entity).alias("ent"), F.col(position).cast("bigint").alias("pos"), block.alias("blk"), *{c: 0 for c in [text, start, end, *latest]})
        .repartition("ent", "blk")
        .groupBy("ent", "blk", "pos")
        .agg(last.alias("x"))
        .select("ent", "blk", "pos", "x.*")
        .withColumn("key", spoken_key(composed(F.col("t"))))
    )
    w = Window.partitionBy("ent", "blk").orderBy("pos")
    fresh = ~same_but_slip(F.lag("key").over(w), F.col("key"))
    events = (
        events.withColumn("fresh", fresh)
        # the canonical value is the text a chain of like events began with; chains that touch differ in side
        .withColumn("value", F.last(F.when(F.col("fresh"), F.coalesce("key", F.lit(""))), ignorenulls=True).over(w))
        .withColumn("side", F.sum(F.col("fresh").cast("int")).over(w) % 2)
        .withColumn("rn", F.row_number().over(w))
        .withColumn("at_end", F.lead("pos").over(w).isNull())
    )
    by_value = Window.partitionBy("ent", "blk", "value", "side").orderBy("pos")
    runs = (
        events.withColumn("gap", F.col("rn") - F.row_number().over(by_value))
        .groupBy("ent", "blk", "value", "side", "gap")
        .agg(
            F.min("pos").alias("first_idx"),
            F.max("pos").alias("last_idx"),
            F.count("*").alias("n_events"),
            F.min_by("t", "pos").alias("text"),
            F.min("s").alias("start"),
            F.max("e").alias("end"),
            (F.min("rn") == 1).alias("at_begin"),
            F.max("at_end").alias("at_end"),
            F.min_by("key", "pos").alias("first_key"),
            F.max_by("key", "pos").alias("last_key"),
        )
    )
    border = F.col("at_begin") | F.col("at_end")
    kept = runs.filter(border | ((F.col("n_events") >= min_count) & F.col("first_key").isNotNull()))
    side = Window.partitionBy("ent", "zone").orderBy("first_idx")
    joins = F.col("at_begin") & F.col("border") & same_but_slip(F.lag("last_key").over(side), F.col("first_key"))
    return (
        kept.withColumn("border", border)
        .withColumn("zone", F.when(~F.col("border"), F.col("blk")))
        .withColumn("new", (~joins).cast("int"))
        .withColumn("run", F.sum("new").over(side))
        .filter(F.col("first_key").isNotNull())
        .groupBy("ent", "zone", "run")
        .agg(
            F.min("first_idx").alias("first_idx"),
            F.max("last_idx").alias("last_idx"),
            F.sum("n_events").alias("n_events"),
            F.min_by("text", "first_idx").alias("text"),
            F.min("start").alias("start"),
            F.max("end").alias("end"),
        )
        .filter(F.col("n_events") >= min_count)
        .select(F.col("ent").alias(entity), "first_idx", "last_idx", "n_events", "text", "start", "end", (F.col("end") - F.col("start")).alias("duration"))
    )
