"""Speech regions: merging with a gap, padding, complements, tiling, chunks, overlap joins, frame masks.

Times are integer milliseconds. What needs an entity's neighbours goes through dyadic.py (cells of an entity are spread)
or through joins on (entity, time bin); only frame masks use a window over an entity's frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessitura.operators.dyadic import interval_gaps, merge_intervals
from tessitura.runtime import cut

#: Width of the bins on which intervals meet.
BIN_MS = 60_000


def merge_regions(df: DataFrame, entity: list[str], start: str, end: str, gap_ms: int = 0) -> DataFrame:
    """Periods of regions whose pause is at most gap_ms (inclusive)."""
    wide = df.select(*entity, F.col(start).alias("_a"), F.when(F.col(end) > F.col(start), F.col(end) + gap_ms).alias("_b"))
    return merge_intervals(wide, entity, "_a", "_b").withColumn("end_ms", F.col("end_ms") - gap_ms)


def merge_speech(df: DataFrame, entity: list[str], start: str, end: str, gap_ms: int, least_ms: int) -> DataFrame:
    """Regions of at least least_ms, then merged."""
    return merge_regions(df.filter(F.col(end) - F.col(start) >= least_ms), entity, start, end, gap_ms)


def pad_regions(df: DataFrame, entity: list[str], start: str, end: str, pad_ms: int, gap_ms: int, least_ms: int, duration: str | None = None) -> DataFrame:
    """Regions widened on both sides within [0, duration], filtered and merged."""
    top = F.col(end) + pad_ms if duration is None else F.least(F.col(end) + pad_ms, F.col(duration))
    wide = df.select(*entity, F.greatest(F.lit(0), F.col(start) - pad_ms).alias("_a"), top.alias("_b"))
    return merge_speech(wide, entity, "_a", "_b", gap_ms, least_ms)


def _marks(df: DataFrame, entity: list[str], durations: DataFrame | None) -> DataFrame:
    """Intervals _a, _b just outside the recordings of df: before 0 and, where durations (entity, duration_ms) tells,
    from the end on, so that what lies between them and the regions is a gap."""
    each = df.select(*entity).distinct()
    out = each.select(*entity, F.lit(-1).cast("bigint").alias("_a"), F.lit(0).cast("bigint").alias("_b"))
    if durations is None:
        return out
    ends = durations.select(*entity, F.col("duration_ms").cast("bigint").alias("_a")).withColumn("_b", F.col("_a") + 1)
    whole = durations.select(*entity, F.lit(-1).cast("bigint").alias("_a"), F.lit(0).cast("bigint").alias("_b"))
    return out.unionByName(ends).unionByName(whole)


def within(df: DataFrame, entity: list[str], start: str, end: str, durations: DataFrame) -> DataFrame:
    """df with start and end clamped to 0 and the recording's duration_ms; what is empty then goes. Recordings without a
    duration are clamped at 0 only."""
    d = durations.select(*[F.col(k).alias(f"_d_{k}") for k in entity], "duration_ms")
    on = None
    for k in entity:
        one = F.col(k) == F.col(f"_d_{k}")
        on = one if on is None else on & one
    j = df.join(d, on, "left").withColumns({start: F.greatest(F.lit(0), F.col(start)), end: F.least(F.col(end), F.col("duration_ms"))})
    return j.filter(F.col(end) > F.col(start)).select(df.columns)


def tile(df: DataFrame, entity: list[str], start: str, end: str, durations: DataFrame | None = None) -> DataFrame:
    """(entity, label, begin_ms, end_ms): speaking periods and the quiet between them, before the first and, where
    durations tells, after the last; recordings that only durations has are quiet throughout."""
    if durations is not None:
        df = within(df, entity, start, end, durations)
    periods = merge_intervals(df, entity, start, end)
    quiet = interval_gaps(df.select(*entity, F.col(start).alias("_a"), F.col(end).alias("_b")).unionByName(_marks(df, entity, durations)), entity, "_a", "_b")
    return periods.select(*entity, F.lit("speaking").alias("label"), "begin_ms", "end_ms").unionByName(
        quiet.select(*entity, F.lit("quiet").alias("label"), F.col("gap_start_ms").alias("begin_ms"), F.col("gap_end_ms").alias("end_ms"))
    )


def silences(df: DataFrame, entity: list[str], start: str, end: str, pad_ms: int = 100, least_ms: int = 32, durations: DataFrame | None = None) -> DataFrame:
    """Pauses between padded regions of at least least_ms; with durations, also before the first and after the last."""
    wide = df.select(*entity, (F.col(start) - pad_ms).alias("_a"), (F.col(end) + pad_ms).alias("_b"))
    if durations is not None:
        wide = wide.unionByName(_marks(df, entity, durations))
    return interval_gaps(wide, entity, "_a", "_b").filter(F.col("gap_end_ms") - F.col("gap_start_ms") >= least_ms)


def chunks(df: DataFrame, start: str, end: str, most_ms: int, least_ms: int) -> DataFrame:
    """Each region in chunks of at most most_ms (chunk_idx, chunk_start_ms, chunk_end_ms); chunks under least_ms go."""
    n = F.when(F.lit(most_ms) <= 0, 1).otherwise(F.greatest(F.lit(1), F.ceil((F.col(end) - F.col(start)) / max(most_ms, 1))))
    size = most_ms if most_ms > 0 else 1 << 60
    out = df.filter(F.col(end) > F.col(start)).withColumn("chunk_idx", F.explode(F.sequence(F.lit(0), n.cast("int") - 1)))
    out = out.withColumn("chunk_start_ms", F.col(start) + F.col("chunk_idx").cast("bigint") * size).withColumn("chunk_end_ms", F.least(F.col("chunk_start_ms") + size, F.col(end)))
    return out.filter(F.col("chunk_end_ms") - F.col("chunk_start_ms") >= least_ms)


def overlaps(left: DataFrame, right: DataFrame, entity: str, a: tuple[str, str], b: tuple[str, str]) -> DataFrame:
    """Pairs of rows of one entity whose intervals share time (touching isn't overlap), once each.

    Both sides meet on (entity, bin); a pair is reported in the bin where its common part begins, so a long recording
    spreads over its bins.
    """
    def binned(df: DataFrame, s: str, e: str) -> DataFrame:
        ok = F.col(entity).isNotNull() & (F.col(e) > F.col(s))
        return df.filter(ok).withColumn("_bin", F.explode(F.sequence(F.floor(F.col(s) / BIN_MS), F.floor((F.col(e) - 1) / BIN_MS))))

    x = binned(left, *a)
    y = binned(right, *b).withColumnRenamed(entity, "_entity").withColumnRenamed("_bin", "_bin2")
    common = F.greatest(F.col(a[0]), F.col(b[0]))
    on = (F.col(entity) == F.col("_entity")) & (F.col("_bin") == F.col("_bin2")) & (F.col(a[0]) < F.col(b[1])) & (F.col(b[0]) < F.col(a[1]))
    return x.join(y, on).filter(F.floor(common / BIN_MS) == F.col("_bin")).drop("_bin", "_bin2", "_entity")


def align_units(units: DataFrame, regions: DataFrame, entity: str, unit_id: str, policy: str = "cover", slack_ms: int = 400, pad_ms: int = 100, least_ms: int = 300) -> DataFrame:
    """Units (columns s_ms, e_ms) fitted to the speech regions (r_s, r_e) they overlap.

    policy cover takes the hull of the regions, each side at most slack_ms from the unit; snap moves a side to the hull
    only if that is within slack_ms. Padded, clamped at 0, and dropped under least_ms. vad_status tells whether a
    region was met.
    """
    met = overlaps(units.select(entity, unit_id, "s_ms", "e_ms"), regions.select(entity, "r_s", "r_e"), entity, ("s_ms", "e_ms"), ("r_s", "r_e"))
    hull = met.groupBy(unit_id).agg(F.min("r_s").alias("h_s"), F.max("r_e").alias("h_e"))
    j = units.join(hull, unit_id, "left")
    if policy == "cover":
        s = F.greatest(F.col("h_s"), F.col("s_ms") - slack_ms)
        e = F.least(F.col("h_e"), F.col("e_ms") + slack_ms)
    else:
        s = F.when(F.abs(F.col("h_s") - F.col("s_ms")) <= slack_ms, F.col("h_s")).otherwise(F.col("s_ms"))
        e = F.when(F.abs(F.col("h_e") - F.col("e_ms")) <= slack_ms, F.col("h_e")).otherwise(F.col("e_ms"))
    met_ = F.col("h_s").isNotNull()
    s, e = F.when(met_, s).otherwise(F.col("s_ms")), F.when(met_, e).otherwise(F.col("e_ms"))
    out = j.withColumn("begin_ms", F.greatest(F.lit(0), s - pad_ms)).withColumn("end_ms", e + pad_ms)
    out = out.withColumn("vad_status", F.when(met_, "aligned").otherwise("no_overlap")).drop("h_s", "h_e")
    return out.filter(F.col("end_ms") - F.col("begin_ms") >= least_ms)


def pair_events(df: DataFrame, entity: str, order: str, kind: str, at: str, durations: DataFrame | None = None) -> DataFrame:
    """(entity, start, end): opened by the first SPEAKING since the last QUIET, closed by the next QUIET, else by the
    recording's duration (column duration of durations; NULL without one). With durations, both are clamped to it and
    what is empty then goes."""
    w = Window.partitionBy(entity).orderBy(order)
    group = F.coalesce(F.sum((F.col(kind) == "QUIET").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = df.withColumn("_g", group).groupBy(entity, "_g").agg(F.min(F.when(F.col(kind) == "SPEAKING", F.col(at))).alias("start"), F.min(F.when(F.col(kind) == "QUIET", F.col(at))).alias("end"))
    out = out.filter(F.col("start").isNotNull()).drop("_g")
    if durations is None:
        return out
    j = out.join(durations.select(F.col(entity).alias("_d"), "duration"), F.col(entity) == F.col("_d"), "left")
    j = j.withColumn("start", F.greatest(F.lit(0), F.col("start"))).withColumn("end", F.least(F.coalesce("end", "duration"), "duration"))
    return j.filter(F.col("end").isNull() | (F.col("end") > F.col("start"))).select(entity, "start", "end")


def voiced_tiles(frames: DataFrame, entity: str, order: str, probability: str, volume: str, durations: DataFrame, loud: DataFrame | None = None, params=None, gap_ms: int = 200, least_ms: int = 250, pad_ms: int = 100, search_ms: int = 700) -> DataFrame:
    """(entity, label, begin_ms, end_ms): a recording's frames to speaking and quiet tiles of its duration_ms.

    The voice machine's signals are paired, moved to the loud regions (entity, r_s, r_e) where these are given, merged,
    padded within the recording and completed by what is quiet.
    """
    from tessitura.operators.audio import VoiceParams, voice_signals
    from tessitura.operators.frames import refined

    signals = voice_signals(frames, entity, order, probability, volume, params or VoiceParams())
    lengths = durations.select(entity, (F.col("duration_ms") / 1000).alias("duration"))
    speech = pair_events(signals, entity, "seq", "signal_type", "signal_at", lengths)
    ms = lambda c: F.round(F.col(c) * 1000).cast("bigint")
    rough = cut(speech.select(entity, ms("start").alias("s_ms"), ms("end").alias("e_ms")))  # read several times below
    if loud is not None:
        rough = refined(rough.withColumn("_key", F.concat_ws(":", "s_ms", "e_ms")), loud, entity, "_key", search_ms, gap_ms, least_ms).select(entity, F.col("begin_ms").alias("s_ms"), F.col("end_ms").alias("e_ms"))
    merged = merge_speech(rough, [entity], "s_ms", "e_ms", gap_ms, least_ms)
    wide = merged.select(entity, (F.col("begin_ms") - pad_ms).alias("_s"), (F.col("end_ms") + pad_ms).alias("_e"))
    padded = cut(merge_speech(within(wide, [entity], "_s", "_e", durations), [entity], "_s", "_e", gap_ms, least_ms))
    return tile(padded, [entity], "begin_ms", "end_ms", durations)


def _islands(df: DataFrame, entity: str, order: str, mask: str) -> DataFrame:
    w, v = Window.partitionBy(entity).orderBy(order), Window.partitionBy(entity, mask).orderBy(order)
    run = Window.partitionBy(entity, mask, "_run")
    all_ = Window.partitionBy(entity)
    out = df.withColumn("_n", F.row_number().over(w)).withColumn("_run", F.col("_n") - F.row_number().over(v)).withColumn("_len", F.count("*").over(run))
    return out.withColumn("_first", F.min(F.when(F.col(mask), F.col("_n"))).over(all_)).withColumn("_last", F.max(F.when(F.col(mask), F.col("_n"))).over(all_))


def fill_short_gaps(df: DataFrame, entity: str, order: str, mask: str, most: int) -> DataFrame:
    """Inner runs of False of at most ``most`` frames become True."""
    inner = ~F.col(mask) & (F.col("_n") > F.col("_first")) & (F.col("_n") < F.col("_last")) & (F.col("_len") <= most)
    return _islands(df, entity, order, mask).withColumn(mask, F.col(mask) | F.coalesce(inner, F.lit(False))).select(df.columns)


def drop_short_runs(df: DataFrame, entity: str, order: str, mask: str, least: int) -> DataFrame:
    """Runs of True under ``least`` frames become False."""
    return _islands(df, entity, order, mask).withColumn(mask, F.col(mask) & (F.col("_len") >= least)).select(df.columns)


def pad_hull(df: DataFrame, entity: str, order: str, mask: str, pad: int) -> DataFrame:
    """The whole span from the first to the last True frame, widened by ``pad``, becomes True (one hull, not each run)."""
    inside = F.col("_n").between(F.col("_first") - pad, F.col("_last") + pad)
    return _islands(df, entity, order, mask).withColumn(mask, F.coalesce(inside, F.lit(False))).select(df.columns)


def mask_segments(df: DataFrame, entity: str, order: str, mask: str, start: str, end: str) -> DataFrame:
    """(entity, start, end) of each run of True frames."""
    runs = _islands(df, entity, order, mask).filter(F.col(mask)).groupBy(entity, "_run")
    return runs.agg(F.min_by(start, "_n").alias("start"), F.max_by(end, "_n").alias("end")).drop("_run")


def widen(df: DataFrame, entity: str, order: str, start: str, end: str, by_ms: int, least_ms: int) -> DataFrame:
    """Segments widened towards their neighbours: not before the first, nor after the last; then under least_ms dropped."""
    w = Window.partitionBy(entity).orderBy(order)
    out = df.withColumn("_p", F.lag(order).over(w)).withColumn("_q", F.lead(order).over(w))
    s = F.when(F.col("_p").isNull(), F.col(start)).otherwise(F.greatest(F.lit(0), F.col(start) - by_ms))
    e = F.when(F.col("_q").isNull(), F.col(end)).otherwise(F.col(end) + by_ms)
    return out.withColumn("begin_ms", s).withColumn("end_ms", e).drop("_p", "_q").filter(F.col("end_ms") - F.col("begin_ms") >= least_ms)
