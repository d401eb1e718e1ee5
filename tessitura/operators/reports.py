"""Evaluation data: references, scored and detailed segments, document scores, drafts of references, comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessitura.functions import align
from tessitura.functions import formats as fmt
from tessitura.functions.text import characters, match_key, tokens, wer_form

#: References by which a reviewer says that nothing is sung or spoken.
NO_WORDS = ("âm thanh không có lời", "không có lời", "không có lời hát", "không lời", "nhạc nền", "nhạc", "instrumental", "im lặng", "không nghe rõ")


def reference_form(c: Column, level: str = "normalized", phrases: tuple[str, ...] = ()) -> Column:
    """A reference as it is compared; '' for NULL and for what only says that there are no words."""
    return F.when(wer_form(c, "normalized", phrases).isin(*NO_WORDS), "").otherwise(wer_form(c, level, phrases))


def references(df: DataFrame, key: str, reference: str, order: str) -> DataFrame:
    """(key, reference): the last of those with one key; blank keys go, a NULL reference is ''."""
    kept = df.filter(F.coalesce(F.trim(F.col(key)), F.lit("")) != "")
    return kept.groupBy(key).agg(F.max_by(F.coalesce(reference, F.lit("")), F.col(order)).alias("reference"))


def segments_of(df: DataFrame, videos: DataFrame, key: str = "video_id") -> DataFrame:
    """Segments of the wanted videos, with times that can't be read as 0 and paths from their shared part on."""
    number = lambda c: F.coalesce(F.when(~F.isnan(F.col(c).try_cast("double")), F.col(c).try_cast("double")), F.lit(0.0)).alias(c)
    changed = {c: number(c) for c in ("start_sec", "end_sec", "duration")} | {"segment_file": fmt.relative_wav(F.col("segment_file")).alias("segment_file")}
    return df.join(videos.select(key).distinct(), key, "left_semi").select(*[changed.get(c, F.col(c)) for c in df.columns])


def video_list(lines: DataFrame, value: str = "value") -> DataFrame:
    """(video_id, source, title) of lines ``id,source,title``; blank lines, comments and lines of one field are left out."""
    flat = F.trim(F.col(value))
    parts = F.split(flat, ",", 3)
    rows = lines.filter((flat != "") & ~flat.startswith("#")).select(parts.alias("p")).filter(F.size("p") >= 2)
    return rows.select(F.trim(F.col("p")[0]).alias("video_id"), F.trim(F.col("p")[1]).alias("source"), F.coalesce(F.trim(F.get("p", F.lit(2))), F.lit("")).alias("title"))


def detail(segments: DataFrame, refs: DataFrame, key: str, text: str, level: str = "normalized") -> DataFrame:
    """A row a segment: counts, wer as text of four decimals ('' without reference), flag, and both compared forms.
    Segments without a reference count as having ''."""
    j = segments.select(key, text).join(refs.select(key, F.col("reference").alias("_ref")), key, "left")
    j = j.withColumns({"reference_norm": reference_form(F.col("_ref"), level), "hypothesis_norm": wer_form(F.col(text), level)})
    j = j.withColumn("_c", align.aligned(tokens(F.col("reference_norm")), tokens(F.col("hypothesis_norm"))))
    c = F.col("_c")
    flag = F.when(align.is_spurious(c), "spurious").when(c["n_ref"] == 0, "no_ref").otherwise("")
    return j.select(key, "_c.n_ref", "_c.n_hyp", c["sub"].alias("S"), c["del"].alias("D"), c["ins"].alias("I"), c["cor"].alias("C"), F.when(c["n_ref"] > 0, F.format_string("%.4f", align.wer(c))).otherwise("").alias("wer"), flag.alias("flag"), "reference_norm", "hypothesis_norm")


def filled_in(sheet: DataFrame, drafts: DataFrame, file: str, key: str) -> DataFrame:
    """Worksheet rows with drafted references (key, draft, rate), in those files in which no reference is filled in yet.

    auto and match_rate tell of the draft; rows without a draft, and files with any reference, stay as they are.
    """
    has = F.coalesce(F.trim("reference"), F.lit("")) != ""
    open_ = sheet.groupBy(F.col(file).alias("_f")).agg((F.count_if(has) == 0).alias("_open"))
    j = sheet.join(open_, F.col(file).eqNullSafe(F.col("_f")), "left").join(drafts.select(F.col(key).alias("_k"), "draft", "rate"), F.col(key) == F.col("_k"), "left")
    new = F.coalesce(F.col("_open"), F.lit(False)) & F.col("_k").isNotNull()
    values = {"reference": F.when(new, F.col("draft")).otherwise(F.col("reference")), "auto": F.when(new, 1).otherwise(F.col("auto")), "match_rate": F.when(new, F.col("rate")).otherwise(F.col("match_rate"))}
    return j.select(*[values[c].alias(c) if c in values else F.col(c) for c in sheet.columns])


def document_scores(segments: DataFrame, refs: DataFrame, document: str, order: str, text: str, level: str = "normalized") -> DataFrame:
    """(document, words, characters): counts of aligning all of a document's segments, in order, with its reference text.

    refs has (document, reference). A document is one alignment, in one task; memory grows with the width times the root
    of the height.
    """
    whole = segments.groupBy(document).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce(text, F.lit("")).alias("t")))), lambda x: x["t"]), " ").alias("_h"))
    j = refs.select(document, "reference").join(whole, document).select(document, reference_form(F.col("reference"), level).alias("r"), wer_form(F.col("_h"), level).alias("h"))
    return j.select(document, align.aligned(tokens(F.col("r")), tokens(F.col("h"))).alias("words"), align.aligned(characters(F.col("r")), characters(F.col("h"))).alias("characters"))


def shown_words(c: Column) -> Column:
    """array<struct<word, key>> of a lyric: words without signs at their edges and their keys; [..] and words without a
    key are left out."""
    plain = F.regexp_replace(F.coalesce(c, F.lit("")), r"\[[^\]]*\]", " ")
    strip = lambda w: F.regexp_replace(w, r"(?U)^\W+|\W+$", "")
    pairs = F.transform(tokens(plain), lambda w: F.struct(strip(w).alias("word"), F.regexp_replace(F.lower(w), r"[^\p{L}\p{N}_]", "").alias("key")))
    return F.filter(pairs, lambda x: x["key"] != "")


def word_stream(df: DataFrame, entity: str, order: str, text: str) -> DataFrame:
    """(entity, order, word_idx, word, key): the words of all segments in order; words without a key are left out."""
    rows = df.select(entity, order, F.posexplode(tokens(F.col(text))).alias("word_idx", "word"))
    return rows.withColumn("key", match_key(F.col("word"))).filter(F.col("key") != "")


def drafts(segments: DataFrame, lyrics: DataFrame, video: str, key: str, order: str, text: str) -> DataFrame:
    """(video, key, draft, rate): each lyric's words given to the segments of its video by one alignment of both word
    sequences; words that no segment says go with the segment before them. rate is the share of a segment's words that
    the lyric has there, two decimals, NULL for a segment without words.

    lyrics has (video, lyric). A video is one alignment; segments of videos without lyric or words get '' and NULL.
    """
    heard = F.filter(F.transform(tokens(F.col(text)), lambda w: F.regexp_replace(F.lower(w), r"[^\p{L}\p{N}_]", "")), lambda k: k != "")
    said = segments.select(video, key, F.struct(F.col(order).alias("o"), F.col(key).alias("k"), heard.alias("w")).alias("s"))
    per = said.groupBy(video).agg(F.array_sort(F.collect_list("s")).alias("s")).join(lyrics.select(video, shown_words(F.col("lyric")).alias("lyric")), video)
    flat = F.flatten(F.transform("s", lambda x, i: F.transform(x["w"], lambda w: F.struct(i.alias("at"), w.alias("w")))))
    at = align.aligned_places(F.transform("lyric", lambda x: x["key"]), F.transform("heard", lambda x: x["w"]))
    per = per.withColumn("heard", flat).filter(F.size("heard") > 0).withColumn("at", at)
    place = lambda i: F.get("at", i)
    of = lambda x, i: F.struct(F.get("heard", F.when(place(i) < 0, -1 - place(i)).otherwise(place(i)))["at"].alias("seg"), x["word"].alias("w"), (place(i) >= 0).alias("same"))
    # a row a word without its video's arrays; outer, as the filter that the optimizer infers from an inner one would hold the Python function
    words = per.select(video, F.transform("lyric", of).alias("words")).select(video, F.posexplode_outer("words").alias("i", "x")).filter(F.col("i").isNotNull())
    got = words.groupBy(video, F.col("x.seg").alias("_seg")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", F.col("x.w").alias("w")))), lambda x: x["w"]), " ").alias("draft"),
        F.count_if("x.same").alias("hits"),
    )
    each = said.withColumn("_seg", F.row_number().over(Window.partitionBy(video).orderBy("s")) - 1)
    n = F.size("s.w")
    sung = lyrics.select(F.col(video).alias("_v")).distinct()
    out = each.join(got, [video, "_seg"], "left").join(sung, F.col(video) == F.col("_v"), "left")
    rate = F.when((n > 0) & F.col("_v").isNotNull(), F.round(F.coalesce("hits", F.lit(0)) / n, 2))
    return out.select(video, key, F.coalesce("draft", F.lit("")).alias("draft"), rate.alias("rate"))


def review_summary(df: DataFrame) -> DataFrame:
    """One row over the segments for review: how many there are, reviewed with a reference, skipped though words were
    heard, pending, and the micro-average of windowed errors of the reviewed (NULL if there are none)."""
    rows = df.filter(F.col("quality_label") == "needs_review").select(F.coalesce(F.when(F.trim("review_status") != "", F.col("review_status")), F.lit("pending")).alias("status"), tokens(wer_form(F.col("reference"))).alias("r"), tokens(wer_form(F.col("text"))).alias("h"))
    rows = rows.withColumn("c", align.aligned(F.col("r"), F.col("h"), windowed=True))
    reviewed = (F.col("status") == "reviewed") & (F.size("r") > 0)
    return rows.agg(
        F.count("*").alias("total_needs_review"),
        F.count_if(reviewed).alias("reviewed"),
        F.count_if((F.col("status") == "skipped") & (F.size("h") > 0)).alias("spurious"),
        F.count_if(~reviewed & (F.col("status") != "skipped")).alias("pending"),
        F.try_divide(F.sum(F.when(reviewed, align.errors(F.col("c")))), F.sum(F.when(reviewed, F.col("c.n_ref")))).alias("micro_wer"),
    )


def lost_and_found(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, change): distinct keys that only one of two runs has, fixed (only before) or new (only after)."""
    a, b = before.select(key).distinct(), after.select(key).distinct()
    return a.exceptAll(b).withColumn("change", F.lit("fixed")).unionByName(b.exceptAll(a).withColumn("change", F.lit("new")))


def compared(old: DataFrame, new: DataFrame, key: str, value: str, higher_is_better: Column) -> DataFrame:
    """(key, old, new, change, verdict) of two runs' metrics; the verdict is better, worse, same, or NULL where one is missing."""
    j = old.select(key, F.col(value).alias("old")).join(new.select(key, F.col(value).alias("new")), key, "full_outer").withColumn("change", F.col("new") - F.col("old"))
    up = higher_is_better
    verdict = F.when(F.col("change") == 0, "same").when((F.col("change") > 0) == up, "better").when(F.col("change").isNotNull(), "worse")
    return j.withColumn("verdict", verdict)


def detection_by_file(df: DataFrame, file: str, probability: str, volume: str, threshold: float = 0.7, least: float = 0.6) -> DataFrame:
    """Frames, detected frames and their share of each file: probability and smoothed volume reach their thresholds."""
    hit = (F.col(probability) >= threshold) & (F.col(volume) >= least)
    out = df.groupBy(file).agg(F.count("*").alias("n_frames"), F.count_if(hit).alias("n_detected"))
    return out.withColumn("ratio", F.col("n_detected") / F.col("n_frames"))


def weighted_loss(df: DataFrame, probability: str, label: str, positive: float = 1.0, tiny: float = 1e-7) -> DataFrame:
    """Mean binary cross entropy, rows of label 1 weighing ``positive``; NULLs are left out."""
    p = F.least(F.lit(1 - tiny), F.greatest(F.lit(tiny), F.col(probability)))
    y = F.col(label).cast("double")
    each = -F.when(y >= 0.5, positive).otherwise(1.0) * (y * F.ln(p) + (1 - y) * F.ln(1 - p))
    return df.filter(F.col(probability).isNotNull() & F.col(label).isNotNull()).agg(F.avg(each).alias("loss"), F.count("*").alias("n"))
