"""Queries of evaluation data, frames, the segment pipeline, selections and exports over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessitura.functions import align
from tessitura.functions import formats as fmt
from tessitura.functions import text as tx
from tessitura.operators import audio, captions, exports, frames, jobs, regions, reports, segments, select
from tessitura.operators.dyadic import to_ms
from tessitura.plans.captions_q import _E, _FORM, _MS, _S, _UNITS, _align, _region_rows
from tessitura.runtime import table


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "worksheets")
    return w.select("ws_id", tx.wer_form(F.col("reference"), "raw").alias("r"), tx.wer_form(F.col("hypothesis"), "raw").alias("h"))


def q_edit_counts(spark, d):
    c = _pairs(spark, d).select("ws_id", align.aligned(tx.tokens(F.col("r")), tx.tokens(F.col("h"))).alias("c"))
    return c.select("ws_id", "c.n_ref", "c.n_hyp", align.errors(F.col("c")).alias("n_errors"))


def q_align_ops(spark, d):
    """The operations of each alignment tell both sides again, at the least cost."""
    o = _pairs(spark, d).select("ws_id", align.aligned_ops(tx.tokens(F.col("r")), tx.tokens(F.col("h"))).alias("o"))
    side = lambda n: F.array_join(F.transform(F.filter("o", lambda x: x[n].isNotNull()), lambda x: x[n]), " ")
    c = align.counts_of(F.col("o"))
    return o.select("ws_id", side("ref").alias("ref"), side("hyp").alias("hyp"), align.errors(c).cast("bigint").alias("n_errors"))


def q_char_counts(spark, d):
    c = _pairs(spark, d).select("ws_id", align.aligned(tx.characters(F.col("r")), tx.characters(F.col("h"))).alias("c"))
    return c.select("ws_id", "c.n_ref", "c.n_hyp", align.errors(F.col("c")).alias("n_errors"))


def q_alignment_lines(spark, d):
    o = _pairs(spark, d).select("ws_id", align.shown(align.aligned_ops(tx.tokens(F.col("r")), tx.tokens(F.col("h")))).alias("lines"))
    return o.select("ws_id", F.size(F.split("lines", "\n")).alias("n_lines"))


def q_detail(spark, d):
    w = table(spark, d, "worksheets")
    x = reports.detail(w, w, "ws_id", "hypothesis", "raw")
    return x.select("ws_id", "n_ref", "n_hyp", (F.col("S") + F.col("D") + F.col("I")).alias("n_errors"), "wer", "flag")


def q_references(spark, d):
    return reports.references(table(spark, d, "worksheets"), "segment_id", "reference", "ws_id")


def q_filled_in(spark, d):
    w = table(spark, d, "worksheets")
    drafts = reports.references(table(spark, d, "segments").withColumn("o", F.struct("exported_at", "text")), "segment_id", "text", "o").select("segment_id", F.col("reference").alias("draft"), F.lit(0.5).alias("rate"))
    return reports.filled_in(w, drafts, "segment_id", "segment_id").select("ws_id", "reference", "auto", F.when(~F.isnan("match_rate"), F.col("match_rate")).alias("match_rate"))


def q_document_scores(spark, d):
    w = table(spark, d, "worksheets").filter("segment_id is not null")
    x = reports.document_scores(w, reports.references(w, "segment_id", "reference", "ws_id"), "segment_id", "ws_id", "hypothesis", "raw")
    return x.select("segment_id", F.col("words.n_ref").alias("n_ref"), F.col("words.n_hyp").alias("n_hyp"), align.errors(F.col("words")).alias("word_errors"), align.errors(F.col("characters")).alias("character_errors"))


def q_drafts(spark, d):
    """References drafted from the whole text of a recording for its segments."""
    s = jobs.latest(table(spark, d, "segments").filter("video_id is not null and segment_id is not null"), ["segment_id"], ["exported_at", "text"])
    one = s.filter("trim(video_id) <> ''").select("video_id", "segment_id", "text")
    hot = one.groupBy("video_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment_id", "text"))), lambda x: x["text"]), " ").alias("lyric"))
    return reports.drafts(one, hot, "video_id", "segment_id", "segment_id", "text")


def q_review_summary(spark, d):
    return reports.review_summary(table(spark, d, "segments")).drop("micro_wer")


def q_lost_found(spark, d):
    s = table(spark, d, "segments").filter("segment_id is not null")
    return reports.lost_and_found(s.filter("review_status = 'pending'"), s.filter("review_status = 'approved'"), "segment_id")


def q_video_list(spark, d):
    s = table(spark, d, "segments").select(F.concat_ws(",", "video_id", "transcript_source", "title").alias("value")).distinct()
    return reports.video_list(s)


def q_segments_of(spark, d):
    s = table(spark, d, "segments")
    out = reports.segments_of(s, s.filter("quality_label = 'music'").select("video_id"))
    return out.select("segment_id", "start_sec", "end_sec", "duration", "segment_file")


def q_word_stream(spark, d):
    return reports.word_stream(table(spark, d, "worksheets").filter("reference is not null"), "segment_id", "ws_id", "reference").select("ws_id", "word_idx", "key")


def q_compared(spark, d):
    u = table(spark, d, "pipeline_job_urls")
    one = lambda s: u.filter(F.col("status") == s).groupBy("job_id").agg(F.count("*").alias("n"))
    return reports.compared(one("completed"), one("failed"), "job_id", "n", F.lit(True))


def q_detection_by_file(spark, d):
    return reports.detection_by_file(table(spark, d, "lineitem"), "l_suppkey", "l_discount", "l_tax", 0.05, 0.03)


def q_weighted_loss(spark, d):
    x = table(spark, d, "lineitem").select((F.col("l_discount") * 9).alias("p"), (F.col("l_tax") >= 0.05).alias("y"))
    return reports.weighted_loss(x, "p", "y", 2.0).select(F.round("loss", 8).alias("loss"), "n")


def _region_ms(spark, d):
    r = table(spark, d, "speech_regions").filter("audio_id is not null")
    return r.select("audio_id", "region_id", to_ms(F.col("start_sec")).alias("s_ms"), to_ms(F.col("end_sec")).alias("e_ms"))


def q_frame_labels(spark, d):
    r = _region_ms(spark, d)
    n = r.groupBy("audio_id").agg(F.ceil(F.max("e_ms") / 1000).alias("n"))
    return frames.labelled_frames(n, r, "audio_id", "n", "s_ms", "e_ms", 1000).groupBy("audio_id").agg(F.count("*").alias("n_frames"), F.sum("label").alias("n_speech"))


def q_refined(spark, d):
    c = table(spark, d, "transcript_cues").select("audio_id", to_ms(F.col("start_sec")).alias("r_s"), to_ms(F.col("end_sec")).alias("r_e"))
    return frames.refined(_region_ms(spark, d).filter("e_ms > s_ms"), c, "audio_id", "region_id")


def _durations(spark, d):
    c = table(spark, d, "transcript_cues").filter("audio_id is not null")
    return c.groupBy("audio_id").agg(F.max(to_ms(F.col("end_sec"))).alias("duration_ms")).filter("duration_ms > 0")


def q_tiles_of_recordings(spark, d):
    return regions.tile(_region_ms(spark, d), ["audio_id"], "s_ms", "e_ms", _durations(spark, d))


def q_silences_of_recordings(spark, d):
    r = regions.within(_region_ms(spark, d), ["audio_id"], "s_ms", "e_ms", _durations(spark, d))
    return regions.silences(r, ["audio_id"], "s_ms", "e_ms", durations=_durations(spark, d))


def q_voiced_tiles(spark, d):
    """Speaking and quiet tiles of each user's events, read as frames of 32 ms."""
    e = table(spark, d, "events").filter("user_id is not null").select("user_id", "event_id", F.least(F.lit(1.0), F.col("value") / 100).alias("p"), F.lit(0.9).alias("v"))
    n = e.groupBy("user_id").agg((F.count("*") * 32).alias("duration_ms"))
    p = audio.VoiceParams(confidence=0.5, min_volume=0.1, start_secs=0.064, stop_secs=0.064)
    t = regions.voiced_tiles(e, "user_id", "event_id", "p", "v", n, params=p, gap_ms=64, least_ms=64, pad_ms=32)
    # tiles fill their recording
    return t.groupBy("user_id").agg(F.sum(F.col("end_ms") - F.col("begin_ms")).alias("total_ms"), F.min("begin_ms").alias("first_ms"), F.max("end_ms").alias("last_ms"))


def _levels(spark, d):
    e = table(spark, d, "events").filter("user_id is not null")
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    return e.select("user_id", n.cast("bigint").alias("frame"), F.coalesce("value", F.lit(0.0)).alias("rms"))


def q_energy_regions(spark, d):
    return frames.energy_regions(_levels(spark, d), "user_id", "frame", "rms", below_db=6.0)


def q_smoothed(spark, d):
    return frames.smoothed(_levels(spark, d), "user_id", "frame", "rms").select("user_id", "frame", F.round("smoothed", 6).alias("smoothed"))


def q_sources_together(spark, d):
    parts = {"cues": table(spark, d, "transcript_cues").select("audio_id", "text"), "units": table(spark, d, "sentence_units").select("audio_id", "text", "lang")}
    return frames.with_source(parts).groupBy("source").agg(F.count("*").alias("n"), F.count("lang").alias("n_lang"))


def q_shuffle_split(spark, d):
    return frames.shuffle_split(table(spark, d, "segments").filter("segment_id is not null"), "segment_id", 0.1).select("segment_id", "split")


def q_draws(spark, d):
    w = table(spark, d, "documents")
    return frames.drawn(w, "doc_id", F.col("n_chars"), 500, float(w.agg(F.sum("n_chars")).head()[0])).select("doc_id", "draws")


def _segment_rows(spark, d):
    u = table(spark, d, "sentence_units")
    units = u.select("audio_id", "unit_id", to_ms(F.col("start_sec")).alias("s_ms"), to_ms(F.col("end_sec")).alias("e_ms"), "text").filter("e_ms > s_ms and audio_id is not null")
    info = jobs.latest(table(spark, d, "segments").filter("audio_id is not null"), ["audio_id"], ["exported_at", "segment_id"]).select("audio_id", "video_id", "title", "source_url")
    return segments.segment_rows(units, _region_rows(spark, d), info)


def q_segment_rows(spark, d):
    """Rows of the segment pipeline, an audio's in all, by what the alignment met."""
    return _segment_rows(spark, d).groupBy("audio_id", "vad_status").agg(F.count("*").alias("n"), F.round(F.sum("duration"), 3).alias("speech_sec"), F.min("segment_id").isNotNull().alias("named"))


def q_segment_manifest(spark, d):
    return _segment_rows(spark, d)


def q_segment_outputs(spark, d):
    return segments.outputs(_segment_rows(spark, d))["summary"]


def q_newest(spark, d):
    return select.newest(table(spark, d, "pipeline_job_urls"), "created_at", "id", 500).select("id", "status")


def q_slice(spark, d):
    return select.sliced(table(spark, d, "pipeline_job_urls").select("id", "url"), [F.col("url"), F.col("id")], 10, 60)


def q_quota(spark, d):
    docs = table(spark, d, "documents").filter("source is not null and channel is not null")
    taken = table(spark, d, "documents").filter("lang = 'hi'").select("channel")
    return select.within_quota(docs.select("source", "channel", F.col("n_chars").alias("score")).groupBy("source", "channel").agg(F.max("score").alias("score")), "source", "channel", "score", 40, 8, taken)


def q_step_history(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type")
    return select.step_history(e, "user_id", "event_id", "event_type", "click")


def q_children(spark, d):
    u = table(spark, d, "pipeline_job_urls")
    return select.with_children(u.select("job_id").distinct(), u.filter("status <> 'completed'"), "job_id", "job_id", "id", ["id", "status"])


def q_requeued(spark, d):
    u = table(spark, d, "pipeline_job_urls")
    j = u.groupBy("job_id").agg(F.when(F.count_if(F.col("status") == "failed") > 3, "failed").otherwise("running").alias("status"))
    return select.requeued(j, u, "job_id", "job_id")


def q_changed_status(spark, d):
    u = select.changed_status(table(spark, d, "pipeline_job_urls"), F.col("job_id") > 3, "failed", "queued")
    return u.groupBy("status").agg(F.count("*").alias("n"), F.count_if("was_changed").alias("n_changed"))


def q_listed(spark, d):
    return table(spark, d, "segments").select(F.explode(select.listed(F.col("quality_reasons"), ",")).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def q_longest_first(spark, d):
    return select.longest_first(table(spark, d, "segments").filter("title is not null"), "title").limit(50)


def q_host_labels(spark, d):
    u = table(spark, d, "pipeline_job_urls").select("id", F.when(F.col("id") % 3 == 0, F.col("url")).otherwise(F.concat(F.lit("http://me:key"), "id", F.lit("@proxy"), F.col("job_id"), F.lit(".example:80"), F.col("id") % 10)).alias("a"))
    return u.select("id", select.host_label(F.col("a")).alias("host"))


def q_params(spark, d):
    p = table(spark, d, "part")
    given = {"size": F.col("p_size"), "brand": F.when(F.col("p_size") > 10, F.col("p_brand"))}
    return p.select("p_partkey", select.params_text(**given).alias("params"), F.get_json_object(select.snapshot(**given), "$.brand").alias("brand"), select.cursor(select.snapshot(cursor=F.col("p_size"))).alias("at"))


def q_signed(spark, d):
    u = table(spark, d, "part").select("p_partkey", ((F.col("p_size") - 25) / 4).alias("x"))
    return u.select("p_partkey", select.signed(F.col("x")).alias("change"), select.first_positive(F.col("x"), -F.col("x")).alias("size"))


def q_tasks(spark, d):
    w = table(spark, d, "worksheets").select(F.concat_ws("\t", fmt.relative_wav(F.col("wav_path")), "reference").alias("value"))
    return select.labelling_tasks(w).groupBy("audio").agg(F.count("*").alias("n"), F.count_if(F.col("text") == "").alias("n_blank"))


def q_catalogue(spark, d):
    s = table(spark, d, "segments")
    audio = s.select(F.concat(F.lit("/data/"), "segment_id", F.lit(".wav")).alias("path")).filter("path is not null").distinct()
    have = s.filter("quality_label = 'speech_clean' and trim(video_id) <> ''").select("video_id", F.concat(F.lit("/vtt/"), "video_id", F.lit(".vtt")).alias("path")).distinct()
    return select.catalogue(audio, have)


def q_video_keys(spark, d):
    return table(spark, d, "segments").select("source_url").distinct().select("source_url", fmt.video_key(F.col("source_url")).alias("video_key"))


def _boxes(spark, d):
    x = table(spark, d, "part").select(F.concat(F.lit("img"), F.col("p_partkey") % 97).alias("image"), F.col("p_brand").alias("label"), (F.col("p_size") * 1.0).alias("x"), (F.col("p_partkey") % 40 * 1.0).alias("y"), (F.col("p_size") % 7 + 1.0).alias("w"), (F.col("p_partkey") % 11 + 1.0).alias("h"))
    return x.withColumns({"width": F.lit(640), "height": F.lit(480), "degrees": F.lit(0.0)})


def q_coco(spark, d):
    c = exports.coco_rows(_boxes(spark, d), "image", "label")["annotations"]
    return c.groupBy("image_id", "category_id").agg(F.count("*").alias("n"), F.round(F.sum("area"), 4).alias("area"))


def q_corner_boxes(spark, d):
    b = exports.corner_boxes(_boxes(spark, d))
    return b.groupBy("image").agg(*[F.sum(c).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


def q_label_files(spark, d):
    ids = jobs.label_ids(_boxes(spark, d), "label", {})
    return exports.label_files(exports.centre_lines(_boxes(spark, d).join(ids, "label"), "label_id"), "image").select("image", F.size(F.split("content", "\n")).alias("n_lines"))


def q_voc(spark, d):
    v = exports.voc_xml(exports.corner_boxes(_boxes(spark, d)), "image", "label")
    return v.select("image", F.regexp_count("content", F.lit("<object>")).alias("n_objects"))


def q_conll(spark, d):
    u = table(spark, d, "sentence_units").filter("text is not null").select("unit_id", tx.squeeze(F.col("text")).alias("text")).filter("text <> ''")
    spans = u.select("unit_id", F.lit(0).alias("start"), F.lit(1).alias("end"), F.lit("HEAD").alias("label"))
    return exports.conll_lines(exports.bio_tokens(u, spans, "unit_id", "text"), "unit_id")


def q_tag_of(spark, d):
    schema = spark.createDataFrame([("view", "vi"), ("click", "c.i"), ("cl", "c"), ("purchase_any", "pur")], "tag string, pattern string")
    return exports.tag_of(table(spark, d, "events").select(F.col("event_type").alias("from_name")), schema)


def q_asr_manifest(spark, d):
    m = exports.asr_manifest(table(spark, d, "segments"), "segment_file", "text", "duration")
    return m.select(F.get_json_object("value", "$.audio_filepath").alias("audio"), exports.said(F.get_json_object("value", "$.text")).alias("text"))


def _inline(spark, d):
    """Caption files of one cue each, of the cues that have inline times."""
    c = table(spark, d, "transcript_cues").filter(F.col("text").rlike(r"<\d{2}:\d{2}:\d{2}\.\d{3}>") & (F.col("end_sec") > F.col("start_sec")))
    at = lambda s: F.date_format(F.timestamp_millis(to_ms(F.col(s))), "HH:mm:ss.SSS")
    return c.select("cue_id", F.concat(F.lit("WEBVTT\n\n"), at("start_sec"), F.lit(" --> "), at("end_sec"), F.lit("\n"), "text", F.lit("\n")).alias("vtt"))


def q_timed_words(spark, d):
    w = captions.parse_words(_inline(spark, d), "vtt")
    return w.groupBy("cue_id").agg(F.count("*").alias("n_words"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word_idx", "word"))), lambda x: x["word"]), " ").alias("words"))


_R, _H = _FORM.format("coalesce(reference, '')"), _FORM.format("coalesce(hypothesis, '')")
_split = lambda c: f"list_filter(string_split({c}, ' '), lambda x: x <> '')"
_chars = lambda c: f"list_filter(regexp_extract_all({c}, '\\S'), lambda x: x <> '')"


def _distance(a: str, b: str) -> str:
    """Edit distance of two lists of up to 90 different words: each word becomes a character."""
    code = lambda x: f"coalesce(array_to_string(list_transform({x}, lambda q: chr((35 + list_position(list_distinct(list_concat({a}, {b})), q))::INT)), ''), '')"
    return f"CAST(levenshtein({code(a)}, {code(b)}) AS BIGINT)"


_WS = f"WITH f AS (SELECT ws_id, segment_id, {_R} AS rf, {_H} AS hf FROM worksheets), w AS (SELECT *, {_split('rf')} AS r, {_split('hf')} AS h, {_chars('rf')} AS rc, {_chars('hf')} AS hc FROM f)"
_KEY = "regexp_extract(trim(source_url), '[?&]v=([^&#\\s]+)', 1)"
SQL = {
    "q_edit_counts": f"{_WS} SELECT ws_id, len(r)::INT AS n_ref, len(h)::INT AS n_hyp, {_distance('r', 'h')}::INT AS n_errors FROM w",
    "q_align_ops": f"{_WS} SELECT ws_id, rf AS ref, hf AS hyp, {_distance('r', 'h')} AS n_errors FROM w",
    "q_char_counts": f"{_WS} SELECT ws_id, len(rc)::INT AS n_ref, len(hc)::INT AS n_hyp, {_distance('rc', 'hc')}::INT AS n_errors FROM w",
    "q_alignment_lines": "SELECT ws_id, 3 AS n_lines FROM worksheets",
    "q_detail": f"{_WS} SELECT ws_id, len(r)::INT AS n_ref, len(h)::INT AS n_hyp, {_distance('r', 'h')}::INT AS n_errors, CASE WHEN len(r) > 0 THEN printf('%.4f', {_distance('r', 'h')} / len(r)::DOUBLE) ELSE '' END AS wer, CASE WHEN len(r) = 0 AND len(h) > 0 THEN 'spurious' WHEN len(r) = 0 THEN 'no_ref' ELSE '' END AS flag FROM w",
    "q_references": "SELECT segment_id, arg_max(coalesce(reference, ''), ws_id) AS reference FROM worksheets WHERE trim(segment_id) <> '' GROUP BY 1",
    "q_filled_in": """WITH d AS (SELECT segment_id, arg_max(coalesce(text, ''), (exported_at, text)) AS draft FROM segments WHERE trim(segment_id) <> '' GROUP BY 1),
o AS (SELECT segment_id, count(*) FILTER (trim(reference) <> '') = 0 AS o FROM worksheets GROUP BY 1)
SELECT w.ws_id, CASE WHEN o.o AND d.segment_id IS NOT NULL THEN d.draft ELSE w.reference END AS reference, CASE WHEN o.o AND d.segment_id IS NOT NULL THEN 1 ELSE w.auto END AS auto,
  CASE WHEN o.o AND d.segment_id IS NOT NULL THEN 0.5 WHEN NOT isnan(w.match_rate) THEN w.match_rate END AS match_rate
FROM worksheets w LEFT JOIN o ON w.segment_id IS NOT DISTINCT FROM o.segment_id LEFT JOIN d ON w.segment_id = d.segment_id""",
    "q_document_scores": f"""WITH s AS (SELECT segment_id, string_agg(coalesce(hypothesis, ''), ' ' ORDER BY ws_id) AS hypothesis, arg_max(coalesce(reference, ''), ws_id) AS reference FROM worksheets WHERE trim(segment_id) <> '' GROUP BY 1),
f AS (SELECT segment_id, {_R} AS rf, {_H} AS hf FROM s), w AS (SELECT *, {_split('rf')} AS r, {_split('hf')} AS h, {_chars('rf')} AS rc, {_chars('hf')} AS hc FROM f)
SELECT segment_id, len(r)::INT AS n_ref, len(h)::INT AS n_hyp, {_distance('r', 'h')}::INT AS word_errors, {_distance('rc', 'hc')}::INT AS character_errors FROM w""",
    "q_review_summary": """WITH s AS (SELECT coalesce(CASE WHEN trim(review_status) <> '' THEN review_status END, 'pending') AS s, regexp_matches(coalesce(reference, ''), '[\\p{L}\\p{N}]') AS r, regexp_matches(coalesce(text, ''), '[\\p{L}\\p{N}]') AS h FROM segments WHERE quality_label = 'needs_review')
SELECT count(*) AS total_needs_review, count(*) FILTER (s = 'reviewed' AND r) AS reviewed, count(*) FILTER (s = 'skipped' AND h) AS spurious, count(*) FILTER (NOT (s = 'reviewed' AND r) AND s <> 'skipped') AS pending FROM s""",
    "q_lost_found": "WITH a AS (SELECT DISTINCT segment_id FROM segments WHERE review_status = 'pending' AND segment_id IS NOT NULL), b AS (SELECT DISTINCT segment_id FROM segments WHERE review_status = 'approved' AND segment_id IS NOT NULL) SELECT segment_id, 'fixed' AS change FROM a WHERE segment_id NOT IN (FROM b) UNION ALL SELECT segment_id, 'new' FROM b WHERE segment_id NOT IN (FROM a)",
    "q_video_list": "WITH s AS (SELECT DISTINCT trim(concat_ws(',', video_id, transcript_source, title)) AS v FROM segments), p AS (SELECT string_split(v, ',') AS p FROM s WHERE v <> '' AND v NOT LIKE '#%') SELECT trim(p[1]) AS video_id, trim(p[2]) AS source, coalesce(trim(array_to_string(p[3:], ',')), '') AS title FROM p WHERE len(p) >= 2",
    "q_segments_of": "SELECT segment_id, CASE WHEN isnan(start_sec) OR start_sec IS NULL THEN 0 ELSE start_sec END AS start_sec, CASE WHEN isnan(end_sec) OR end_sec IS NULL THEN 0 ELSE end_sec END AS end_sec, CASE WHEN isnan(duration) OR duration IS NULL THEN 0 ELSE duration END AS duration, segment_file FROM segments WHERE video_id IN (SELECT video_id FROM segments WHERE quality_label = 'music' AND video_id IS NOT NULL)",
    "q_word_stream": f"WITH t AS (SELECT ws_id, list_filter(string_split(regexp_replace(reference, '[\\s\\x{{A0}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{3000}}]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM worksheets WHERE reference IS NOT NULL), u AS (SELECT ws_id, unnest(w) AS x, CAST(unnest(range(len(w))) AS INT) AS word_idx FROM t), k AS (SELECT ws_id, word_idx, replace({_FORM.format('x')}, ' ', '') AS key FROM u) SELECT * FROM k WHERE key <> ''",
    "q_compared": "WITH a AS (SELECT job_id, count(*) AS o FROM pipeline_job_urls WHERE status = 'completed' GROUP BY 1), b AS (SELECT job_id, count(*) AS n FROM pipeline_job_urls WHERE status = 'failed' GROUP BY 1) SELECT coalesce(a.job_id, b.job_id) AS job_id, o AS old, n AS new, n - o AS change, CASE WHEN n = o THEN 'same' WHEN n > o THEN 'better' WHEN n < o THEN 'worse' END AS verdict FROM a FULL JOIN b USING (job_id)",
    "q_detection_by_file": "SELECT l_suppkey, count(*) AS n_frames, count(*) FILTER (l_discount >= 0.05 AND l_tax >= 0.03) AS n_detected, count(*) FILTER (l_discount >= 0.05 AND l_tax >= 0.03) / count(*)::DOUBLE AS ratio FROM lineitem GROUP BY 1",
    "q_weighted_loss": "WITH x AS (SELECT least(1 - 1e-7, greatest(1e-7, l_discount * 9)) AS p, l_tax >= 0.05 AS y FROM lineitem WHERE l_discount IS NOT NULL AND l_tax IS NOT NULL) SELECT round(avg(CASE WHEN y THEN -2 * ln(p) ELSE -ln(1 - p) END), 8) AS loss, count(*) AS n FROM x",
    "q_frame_labels": f"""WITH r AS (SELECT audio_id, {_S} AS s, {_E} AS e FROM speech_regions WHERE audio_id IS NOT NULL), n AS (SELECT audio_id, CAST(ceil(max(e) / 1000.0) AS BIGINT) AS n FROM r GROUP BY 1),
f AS (SELECT audio_id, unnest(range(n)) AS i FROM n WHERE n > 0), h AS (SELECT f.audio_id, i, bool_or(coalesce(least(e, i * 1000 + 1000) - greatest(s, i * 1000) >= 500 AND e > s, false)) AS b FROM f LEFT JOIN r ON r.audio_id = f.audio_id AND r.s < i * 1000 + 1000 AND r.e > i * 1000 GROUP BY 1, 2)
SELECT audio_id, count(*) AS n_frames, count(*) FILTER (b) AS n_speech FROM h GROUP BY 1""",
    "q_refined": f"""WITH r AS (SELECT audio_id, region_id, {_S} AS s, {_E} AS e FROM speech_regions WHERE audio_id IS NOT NULL), c AS (SELECT audio_id, {_S} AS rs, {_E} AS re FROM transcript_cues WHERE audio_id IS NOT NULL AND {_E} > {_S}),
m AS (SELECT r.audio_id, region_id, rs, re, rs < e AND s < re AS d FROM r JOIN c ON r.audio_id = c.audio_id AND rs < e + 700 AND re > greatest(0, s - 700) WHERE e > s),
h AS (SELECT audio_id, region_id, coalesce(min(rs) FILTER (d), min(rs)) AS s, coalesce(max(re) FILTER (d), max(re)) AS e FROM m GROUP BY 1, 2), i AS (SELECT DISTINCT audio_id, s, e FROM h WHERE e - s >= 250),
p AS (SELECT *, max(e) OVER (PARTITION BY audio_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM i), g AS (SELECT *, sum(CASE WHEN pe IS NULL OR s - pe > 200 THEN 1 ELSE 0 END) OVER (PARTITION BY audio_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM p)
SELECT audio_id, min(s) AS begin_ms, max(e) AS end_ms FROM g GROUP BY audio_id, k""",
    "q_tiles_of_recordings": f"""WITH d AS (SELECT audio_id, max({_E}) AS d FROM transcript_cues WHERE audio_id IS NOT NULL GROUP BY 1 HAVING max({_E}) > 0), r AS (SELECT s.audio_id, greatest(0, {_S}) AS s, least(coalesce(d, {_E}), {_E}) AS e FROM speech_regions s LEFT JOIN d ON s.audio_id = d.audio_id WHERE s.audio_id IS NOT NULL),
i AS (SELECT DISTINCT * FROM r WHERE e > s), m AS (SELECT *, max(e) OVER (PARTITION BY audio_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM i), g AS (SELECT *, sum(CASE WHEN pe IS NULL OR s > pe THEN 1 ELSE 0 END) OVER (PARTITION BY audio_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM m),
p AS (SELECT audio_id, min(s) AS a, max(e) AS z FROM g GROUP BY audio_id, k), q AS (SELECT audio_id, a, z FROM p UNION ALL SELECT audio_id, 0, 0 FROM (SELECT audio_id FROM p UNION SELECT audio_id FROM d) UNION ALL SELECT audio_id, d, d FROM d),
h AS (SELECT audio_id, max(z) OVER (PARTITION BY audio_id ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pz, a FROM q)
SELECT audio_id, 'speaking' AS label, a AS begin_ms, z AS end_ms FROM p UNION ALL SELECT audio_id, 'quiet', pz, a FROM h WHERE a > pz""",
    "q_voiced_tiles": "SELECT user_id, count(*) * 32 AS total_ms, 0::BIGINT AS first_ms, count(*) * 32 AS last_ms FROM events WHERE user_id IS NOT NULL GROUP BY 1",
    "q_energy_regions": """WITH l AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS f, coalesce(value, 0) AS v FROM events WHERE user_id IS NOT NULL), p AS (SELECT *, max(v) OVER (PARTITION BY user_id) AS m FROM l),
o AS (SELECT user_id, f FROM p WHERE m > 0 AND v >= greatest(0.0001, m * pow(10, -6.0 / 20))), g AS (SELECT *, CASE WHEN f - lag(f) OVER (PARTITION BY user_id ORDER BY f) - 1 <= 3 THEN 0 ELSE 1 END AS n FROM o),
k AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY f) AS k FROM g), r AS (SELECT user_id, min(f) AS a, max(f) + 1 AS b FROM k GROUP BY user_id, k HAVING max(f) + 1 - min(f) >= 3)
SELECT user_id, greatest(0, min(a) * 32 - 64) AS begin_ms, max(b) * 32 + 64 AS end_ms FROM r GROUP BY 1""",
    "q_smoothed": """WITH l AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS frame, coalesce(value, 0) AS v FROM events WHERE user_id IS NOT NULL), w AS (SELECT user_id, frame, list(v) OVER (PARTITION BY user_id ORDER BY frame ROWS 64 PRECEDING) AS x FROM l)
SELECT user_id, frame, round(list_reduce(list_prepend(0.0::DOUBLE, x), lambda a, y: a + 0.2 * (y - a)), 6) AS smoothed FROM w""",
    "q_sources_together": "SELECT 'cues' AS source, count(*) AS n, 0::BIGINT AS n_lang FROM transcript_cues UNION ALL SELECT 'units', count(*), count(lang) FROM sentence_units",
    "q_segment_rows": "WITH z AS (" + _align("greatest(hs, s - 400)", "least(he, e + 400)") + ") SELECT u.audio_id, z.vad_status, count(*) AS n, round(sum(round((end_ms - begin_ms) / 1000.0::DOUBLE, 3)), 3) AS speech_sec, true AS named FROM z JOIN sentence_units u ON u.unit_id = z.unit_id GROUP BY 1, 2",
    "q_newest": "SELECT id, status FROM pipeline_job_urls ORDER BY created_at DESC, id DESC LIMIT 200",
    "q_slice": "WITH r AS (SELECT id, url, row_number() OVER (ORDER BY url NULLS FIRST, id) - 1 AS row_no FROM pipeline_job_urls) SELECT * FROM r WHERE row_no >= 10 AND row_no < 60",
    "q_quota": """WITH d AS (SELECT source, channel, max(n_chars) AS score FROM documents WHERE source IS NOT NULL AND channel IS NOT NULL GROUP BY 1, 2), t AS (SELECT DISTINCT channel FROM documents WHERE lang = 'hi' AND channel IS NOT NULL),
g AS (SELECT * FROM d WHERE score > 0 AND channel NOT IN (FROM t)), o AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY source, score DESC) AS k FROM g), r AS (SELECT channel, source, score, row_number() OVER (PARTITION BY source ORDER BY score DESC, channel) AS n FROM o WHERE k = 1)
SELECT channel, source, score FROM r WHERE n <= 5 ORDER BY source, n LIMIT 40""",
    "q_step_history": """WITH e AS (SELECT user_id, event_id, event_type, coalesce(lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) = event_type AND event_type <> 'click', false) AS same FROM events), k AS (SELECT user_id, event_id, event_type FROM e WHERE NOT same)
SELECT *, CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS run_no, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS ended_at FROM k""",
    "q_children": "WITH c AS (SELECT job_id, id, status, row_number() OVER (PARTITION BY job_id ORDER BY id)::INT AS n FROM pipeline_job_urls WHERE status <> 'completed') SELECT p.job_id, c.id AS child_id, c.status AS child_status, c.n AS child_no FROM (SELECT DISTINCT job_id FROM pipeline_job_urls) p LEFT JOIN c ON p.job_id = c.job_id",
    "q_requeued": "SELECT job_id, CASE WHEN count(*) FILTER (status = 'failed') > 3 THEN CASE WHEN count(*) FILTER (status = 'queued') > 0 THEN 'queued' ELSE 'failed' END ELSE 'running' END AS status FROM pipeline_job_urls GROUP BY 1",
    "q_changed_status": "SELECT CASE WHEN status = 'failed' AND job_id > 3 THEN 'queued' ELSE status END AS status, count(*) AS n, count(*) FILTER (status = 'failed' AND job_id > 3) AS n_changed FROM pipeline_job_urls GROUP BY 1",
    "q_listed": "WITH r AS (SELECT trim(unnest(string_split(quality_reasons, ','))) AS reason FROM segments) SELECT reason, count(*) AS n FROM r WHERE reason <> '' GROUP BY 1",
    "q_longest_first": "SELECT title FROM (SELECT DISTINCT title FROM segments WHERE title IS NOT NULL) ORDER BY length(title) DESC, title LIMIT 50",
    "q_host_labels": "SELECT id, CASE WHEN id % 3 = 0 THEN 'invalid' ELSE 'http://proxy' || job_id || '.example:80' || (id % 10) END AS host FROM pipeline_job_urls",
    "q_params": "SELECT p_partkey, CASE WHEN p_size > 10 THEN 'size=' || p_size || ' brand=' || p_brand ELSE 'size=' || p_size END AS params, CASE WHEN p_size > 10 THEN p_brand END AS brand, p_size AS at FROM part",
    "q_signed": "SELECT p_partkey, CASE WHEN p_size = 25 THEN '0.0s' WHEN p_size > 25 THEN printf('+%.1fs', round((p_size - 25) / 4.0::DOUBLE, 1)) ELSE printf('%.1fs', round((p_size - 25) / 4.0::DOUBLE, 1)) END AS change, CASE WHEN p_size <> 25 THEN abs(p_size - 25) / 4.0::DOUBLE END AS size FROM part",
    "q_tasks": "SELECT '/data/local-files/?d=audio/' || regexp_extract(replace(wav_path, '\\', '/'), '([^/]*)$', 1) AS audio, count(*) AS n, count(*) FILTER (reference IS NULL OR regexp_replace(reference, '[\\s\\x{A0}\\x{2000}-\\x{200A}\\x{202F}\\x{3000}]+', '', 'g') = '') AS n_blank FROM worksheets GROUP BY 1".replace("'\\\\'", "'\\'"),
    "q_catalogue": "WITH a AS (SELECT DISTINCT '/data/' || segment_id || '.wav' AS path, regexp_replace(string_split(regexp_replace(segment_id || '.wav', '\\.[^.]*$', ''), '__')[1], '^yt_', '') AS video_id FROM segments WHERE segment_id IS NOT NULL), v AS (SELECT DISTINCT video_id FROM segments WHERE quality_label = 'speech_clean' AND trim(video_id) <> '') SELECT a.video_id, a.path, CASE WHEN v.video_id IS NOT NULL THEN '/vtt/' || v.video_id || '.vtt' END AS path_caption FROM a LEFT JOIN v ON a.video_id = v.video_id",
    "q_video_keys": "WITH u AS (SELECT DISTINCT source_url, regexp_replace(lower(regexp_extract(trim(source_url), '^https?://([^/?#]+)', 1)), '^(www\\.|m\\.|music\\.)', '') AS host, regexp_extract(trim(source_url), '^https?://[^/?#]+(/[^?#]*)', 1) AS path, " + _KEY + " AS q FROM segments) SELECT source_url, CASE WHEN host = 'clips.example' AND path = '/watch' AND q <> '' THEN q WHEN host = 'clips.example' AND regexp_extract(path, '^/(?:shorts|embed)/([^/]+)', 1) <> '' THEN regexp_extract(path, '^/(?:shorts|embed)/([^/]+)', 1) WHEN host = 'clip.example' AND regexp_extract(path, '^/([^/]+)', 1) <> '' THEN regexp_extract(path, '^/([^/]+)', 1) END AS video_key FROM u",
    "q_coco": "WITH b AS (SELECT 'img' || (p_partkey % 97) AS image, p_brand AS label, (p_size % 7 + 1.0) * 6.4 * (p_partkey % 11 + 1.0) * 4.8 AS area FROM part), i AS (SELECT image, row_number() OVER (ORDER BY image) - 1 AS image_id FROM (SELECT DISTINCT image FROM b)), c AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS category_id FROM (SELECT DISTINCT label FROM b)) SELECT image_id, category_id, count(*) AS n, round(sum(area::DOUBLE), 4) AS area FROM b JOIN i USING (image) JOIN c USING (label) GROUP BY 1, 2",
    "q_corner_boxes": "WITH b AS (SELECT 'img' || (p_partkey % 97) AS image, p_size * 1.0::DOUBLE * 640 / 100 AS x, (p_partkey % 40) * 1.0::DOUBLE * 480 / 100 AS y, (p_size % 7 + 1.0::DOUBLE) * 640 / 100 AS w, (p_partkey % 11 + 1.0::DOUBLE) * 480 / 100 AS h FROM part) SELECT image, CAST(sum(trunc(x)) AS BIGINT) AS xmin, CAST(sum(trunc(y)) AS BIGINT) AS ymin, CAST(sum(trunc(x + w)) AS BIGINT) AS xmax, CAST(sum(trunc(y + h)) AS BIGINT) AS ymax FROM b GROUP BY 1",
    "q_label_files": "SELECT 'img' || (p_partkey % 97) AS image, count(*)::INT AS n_lines FROM part GROUP BY 1",
    "q_voc": "SELECT 'img' || (p_partkey % 97) AS image, count(*)::INT AS n_objects FROM part GROUP BY 1",
    "q_conll": "WITH u AS (SELECT unit_id, list_filter(regexp_split_to_array(text, '[\\s\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+'), lambda x: x <> '') AS w FROM sentence_units WHERE text IS NOT NULL), t AS (SELECT unit_id, CAST(unnest(range(len(w) + 1)) AS INT) AS line_no, w FROM u WHERE len(w) > 0) SELECT unit_id, line_no, CASE WHEN line_no = len(w) THEN '' ELSE w[line_no + 1] || ' -X- _ ' || CASE WHEN line_no = 0 THEN 'B-HEAD' ELSE 'O' END END AS line FROM t",
    "q_tag_of": "SELECT DISTINCT event_type AS from_name, CASE WHEN event_type IN ('view', 'click', 'cl', 'purchase_any') THEN event_type WHEN regexp_matches(event_type, '^pur') THEN 'purchase_any' WHEN regexp_matches(event_type, '^c.i') THEN 'click' WHEN regexp_matches(event_type, '^vi') THEN 'view' WHEN regexp_matches(event_type, '^c') THEN 'cl' END AS tag FROM events",
    "q_asr_manifest": "SELECT segment_file AS audio, text FROM segments WHERE trim(text) <> ''",
    "q_timed_words": "WITH c AS (SELECT cue_id, regexp_replace(text, '^(.*?)$', '\\1') AS text FROM transcript_cues WHERE regexp_matches(text, '<\\d{2}:\\d{2}:\\d{2}\\.\\d{3}>') AND end_sec > start_sec), w AS (SELECT cue_id, list_filter(regexp_split_to_array(regexp_replace(text, '<[^>]+>', ' ', 'g'), '\\s+'), lambda x: x <> '') AS w FROM c) SELECT cue_id, len(w) AS n_words, array_to_string(w, ' ') AS words FROM w WHERE len(w) > 0",
}
QUERIES = {k: f for k, f in globals().items() if k.startswith("q_")}
