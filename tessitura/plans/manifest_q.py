"""Queries of segments, worksheets, jobs and addresses over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessitura.functions import formats as fmt
from tessitura.operators import evaluate, jobs, manifest
from tessitura.runtime import table


def _segments(spark, d):
    """The latest export of each segment."""
    return jobs.latest(table(spark, d, "segments").filter("segment_id is not null"), ["segment_id"], ["exported_at", "review_status", "text"])


def _latest_state(spark, d):
    s = table(spark, d, "segments").filter("segment_id is not null")
    return s.groupBy("segment_id").agg(F.max("exported_at").alias("exported_at"), F.count("*").alias("n_exports"))


def q_latest_export(spark, d):
    return _latest_state(spark, d)


def q_upsert(spark, d):
    s = table(spark, d, "segments").filter("segment_id is not null")
    cut = F.to_timestamp(F.lit("2025-03-04"))
    old, new = (jobs.latest(s.filter(c), ["segment_id"], ["exported_at", "text"]) for c in (F.col("exported_at") < cut, F.col("exported_at") >= cut))
    return manifest.upsert(old, new, "segment_id").groupBy("quality_label", "review_status").agg(F.count("*").alias("n"))


def q_review_view(spark, d):
    v = manifest.review_view(table(spark, d, "segments"))
    return v.groupBy("review_status", "spurious").agg(F.count("*").alias("n"), F.count("manual_wer").alias("n_rated"))


def q_reason_counts(spark, d):
    return manifest.split_reasons(table(spark, d, "segments")).groupBy("reason").agg(F.count("*").alias("n"))


def q_validation(spark, d):
    return manifest.validation(table(spark, d, "segments"), "duration")


def q_label_quality(spark, d):
    s = table(spark, d, "segments").withColumn("rate", F.when(~F.isnan("manual_wer"), F.col("manual_wer")))
    return evaluate.label_quality(s, "text", "rate", ["transcript_source"])


def q_source_rollup(spark, d):
    s = table(spark, d, "segments")
    return s.rollup("transcript_source", "quality_label").agg(F.count("*").alias("n"), F.round(F.avg("quality_score"), 6).alias("avg_score"))


def _scored(spark, d):
    w = jobs.latest(table(spark, d, "worksheets"), ["segment_id"], ["ws_id"])
    return evaluate.scored(w, "reference", "hypothesis")


def q_wer_detail(spark, d):
    return _scored(spark, d).select("segment_id", *[F.col(f"counts.{c}").alias(c) for c in ("n_ref", "n_hyp", "sub", "del", "ins", "cor")], F.round("wer", 4).alias("wer"), "flag")


def q_wer_windowed(spark, d):
    w = table(spark, d, "worksheets")
    s = evaluate.scored(w, "reference", "hypothesis", windowed=True)
    return s.select("ws_id", *[F.col(f"counts.{c}").alias(c) for c in ("n_ref", "sub", "del", "ins", "cor")])


def q_wer_summary(spark, d):
    return evaluate.summary(_scored(spark, d), ["source"]).withColumn("verdict", evaluate.verdict(F.col("micro_wer")))


def q_wer_rates(spark, d):
    """What a summary says that doesn't depend on which of several best alignments is taken."""
    s = evaluate.summary(_scored(spark, d), ["source"])
    return s.select("source", "n_scored", "n_spurious", "spurious_tokens", "micro_wer", "macro_wer", "n_exact", "n_bad")


def q_wer_worst(spark, d):
    return evaluate.worst(_scored(spark, d), "source", "segment_id").select("source", "segment_id", "n_errors", "rank")


def q_char_distance(spark, d):
    w = table(spark, d, "worksheets").filter("hypothesis is not null and reference is not null")
    return w.select("ws_id", F.levenshtein("hypothesis", "reference").alias("distance"))


def q_review_wer(spark, d):
    s = table(spark, d, "segments").filter("quality_label = 'needs_review'")
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    return s.agg(F.count("*").alias("n"), F.count_if(~blank("reference")).alias("reviewed"), F.count_if(blank("reference") & ~blank("text")).alias("spurious"), F.count_if(F.coalesce("review_status", F.lit("pending")).isin("pending", "")).alias("pending"))


def q_ranking(spark, d):
    s = table(spark, d, "segments").filter("quality_score is not null and not isnan(quality_score)").select(F.round("quality_score", 3).alias("score"), (F.col("quality_label") == "speech_clean").cast("int").alias("label"))
    r = evaluate.ranking(s, "score", "label", 0.7, buckets=1001, span=(-0.0005, 1.0005))
    return r.select(*[F.round(c, 6).alias(c) for c in ("detection", "false_alarm", "auc")])


def q_class_weights(spark, d):
    return evaluate.class_weights(table(spark, d, "segments"), "quality_label").select("quality_label", "n", F.round("weight", 6).alias("weight"))


def q_url_canonical(spark, d):
    u = table(spark, d, "segments").select("source_url").distinct()
    return u.select("source_url", fmt.video_address(F.col("source_url")).alias("address"))


def q_url_distinct(spark, d):
    u = table(spark, d, "pipeline_job_urls").withColumn("address", fmt.video_address(F.col("url"))).filter("address is not null")
    return jobs.first_seen(u, F.col("address"), "id").select("id", "address")


def q_url_states(spark, d):
    return jobs.state_counts(table(spark, d, "pipeline_job_urls"), ["job_id"], "status")


def q_progress(spark, d):
    s = jobs.state_counts(table(spark, d, "pipeline_job_urls"), ["job_id"], "status")
    done = F.col("n_completed") + F.col("n_skipped") + F.col("n_failed")
    return s.select("job_id", fmt.progress(F.lit("normalize_audio"), F.lit("running"), done, F.col("total")).alias("percent"))


def q_batch_status(spark, d):
    return jobs.batch_status(table(spark, d, "pipeline_job_urls"), ["job_id"], "status")


def q_active_videos(spark, d):
    s = table(spark, d, "segments").filter("trim(video_id) <> ''").select("video_id").distinct()
    return jobs.active(s, table(spark, d, "pipeline_job_urls"), "video_id")


def q_unprocessed(spark, d):
    done = table(spark, d, "segments").filter("trim(video_id) <> ''")
    u = table(spark, d, "pipeline_job_urls").filter("trim(video_id) <> ''").select("video_id").distinct()
    return jobs.not_done(u, done, "video_id")


def q_resume(spark, d):
    return jobs.resume(table(spark, d, "pipeline_job_urls"), "status").groupBy("status").agg(F.count("*").alias("n"))


def q_block_siblings(spark, d):
    u = table(spark, d, "pipeline_job_urls").withColumn("status", F.when(F.col("status") == "failed", "blocked").otherwise(F.col("status")))
    return jobs.block_siblings(u, "job_id", "status").groupBy("status").agg(F.count("*").alias("n"))


def q_url_chunks(spark, d):
    return jobs.chunked(table(spark, d, "pipeline_job_urls"), "job_id", "id", 5).select("id", F.col("chunk_no").cast("bigint").alias("chunk_no"))


def q_numbered(spark, d):
    return jobs.numbered(table(spark, d, "segments").select("segment_id", "exported_at", "review_status").distinct().filter("segment_id is not null"), [F.col("segment_id"), F.col("exported_at"), F.col("review_status")]).agg(F.count("*").alias("n"), F.min("row_no").alias("lo"), F.max("row_no").alias("hi"), F.countDistinct("row_no").alias("d"))


def q_query_window(spark, d):
    p = table(spark, d, "part").select((F.col("p_partkey") - 1).alias("pos"), "p_name")
    return jobs.window_of(p, "pos", 17, 20, p.count()).select("pos", F.col("window_idx").cast("bigint").alias("window_idx"))


def q_stage_timings(spark, d):
    return jobs.stage_timings(table(spark, d, "pipeline_job_urls").withColumn("sec", F.when(~F.isnan("source_duration_sec"), F.col("source_duration_sec"))), ["status", "logs_fail"], "sec")


def q_drill_down(spark, d):
    u = table(spark, d, "pipeline_job_urls").withColumn("sec", F.when(~F.isnan("source_duration_sec"), F.col("source_duration_sec")))
    return jobs.drill_down(u, "video_id", "url", "id", ["status"], F.col("status") == "completed", "sec").drop("rows")


def q_run_delta(spark, d):
    o = table(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("run"), "o_orderpriority").agg(F.count("*").alias("n"))
    return jobs.run_delta(o, "run", "o_orderpriority", "n")


def q_label_ids(spark, d):
    return jobs.label_ids(table(spark, d, "events"), "event_type", {"click": 2, "view": 0})


def q_error_kinds(spark, d):
    m = F.col("logs_fail")
    return table(spark, d, "pipeline_job_urls").select("id", fmt.is_rate_limited(m).alias("rate_limited"), fmt.is_skippable(m).alias("skippable"), fmt.is_network_error(m).alias("network"), fmt.is_cookie_error(m).alias("cookie"), fmt.is_auth_failure(m).alias("auth"))


def q_durations(spark, d):
    s = table(spark, d, "segments").filter("not isnan(duration) and duration is not null").select("duration").distinct()
    return s.select("duration", fmt.clock_text(F.col("duration") * 100).alias("clock"))


def q_wav_paths(spark, d):
    return table(spark, d, "worksheets").select("ws_id", fmt.relative_wav(F.col("wav_path")).alias("path"))


def q_json_props(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").alias("k"))


def q_frames(spark, d):
    from tessitura.operators import audio

    v = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    m = audio.metrics(audio.frames(F.col("x"), 16), 0.1)
    return v.select("vec_id", m.alias("m")).select("vec_id", *[F.round(f"m.{c}", 5).alias(c) for c in ("rms", "peak", "active_ratio")])


def q_voice(spark, d):
    from tessitura.operators import audio

    e = table(spark, d, "events").select("user_id", "event_id", F.least(F.lit(1.0), F.col("value") / 100).alias("p"), F.lit(0.9).alias("v"))
    v = audio.voice_signals(e, "user_id", "event_id", "p", "v", audio.VoiceParams(confidence=0.5, min_volume=0.1, start_secs=0.064, stop_secs=0.064))
    return v.withColumn("signal_at", F.round("signal_at", 3))


def q_approx_videos(spark, d):
    """Whether the estimate of distinct videos lies within a tenth of the count."""
    s = table(spark, d, "segments").groupBy("transcript_source").agg(F.approx_count_distinct("video_id", 0.02).alias("a"), F.count_distinct("video_id").alias("n"))
    return s.select("transcript_source", (F.abs(F.col("a") - F.col("n")) <= 0.1 * F.col("n")).alias("near"))


_BLANK = "coalesce(trim({}), '') = ''"
_LAST_SEG = "SELECT segment_id, max(exported_at) AS exported_at, count(*) AS n_exports FROM segments WHERE segment_id IS NOT NULL GROUP BY segment_id"
SQL = {
    "q_latest_export": _LAST_SEG,
    "q_upsert": """WITH s AS (SELECT segment_id, exported_at < TIMESTAMP '2025-03-04' AS is_old, arg_max({'q': quality_label, 'r': review_status}, (exported_at, text)) AS x FROM segments WHERE segment_id IS NOT NULL GROUP BY 1, 2),
j AS (SELECT coalesce(n.segment_id, o.segment_id) AS k, CASE WHEN n.segment_id IS NOT NULL THEN n.x.q ELSE o.x.q END AS quality_label, coalesce(CASE WHEN trim(o.x.r) <> '' THEN o.x.r END, n.x.r) AS r FROM (FROM s WHERE is_old) o FULL JOIN (FROM s WHERE NOT is_old) n ON o.segment_id = n.segment_id)
SELECT quality_label, CASE WHEN quality_label = 'needs_review' AND coalesce(trim(r), '') = '' THEN 'pending' ELSE r END AS review_status, count(*) AS n FROM j GROUP BY 1, 2""",
    "q_review_view": f"SELECT coalesce(CASE WHEN trim(review_status) <> '' THEN review_status END, 'pending') AS review_status, {_BLANK.format('reference')} AND NOT {_BLANK.format('text')} AS spurious, count(*) AS n, count(*) FILTER (manual_wer IS NOT NULL AND NOT isnan(manual_wer)) AS n_rated FROM segments WHERE quality_label = 'needs_review' GROUP BY 1, 2",
    "q_reason_counts": "WITH r AS (SELECT trim(unnest(string_split(quality_reasons, ','))) AS reason FROM segments WHERE quality_reasons IS NOT NULL) SELECT reason, count(*) AS n FROM r WHERE reason <> '' GROUP BY reason",
    "q_validation": "WITH d AS (SELECT CASE WHEN NOT isnan(duration) THEN duration END AS d FROM segments) SELECT count(*) AS n, count(d) AS n_timed, min(d) AS min_sec, round(avg(d), 6) AS avg_sec, max(d) AS max_sec, count(*) FILTER (d < 0.3) AS n_short, count(*) FILTER (d > 12) AS n_long FROM d",
    "q_label_quality": f"WITH s AS (SELECT transcript_source, NOT {_BLANK.format('text')} AS u, CASE WHEN NOT isnan(manual_wer) THEN manual_wer END AS r FROM segments) SELECT transcript_source, count(*) FILTER (u) AS usable, count(*) FILTER (u AND r > 0.5) AS mislabelled, count(*) FILTER (u AND r <= 0.5) / nullif(count(*) FILTER (u), 0)::DOUBLE AS precision FROM s GROUP BY 1",
    "q_source_rollup": "SELECT transcript_source, quality_label, count(*) AS n, round(avg(quality_score), 6) AS avg_score FROM segments GROUP BY ROLLUP (transcript_source, quality_label)",
    "q_review_wer": f"SELECT count(*) AS n, count(*) FILTER (NOT {_BLANK.format('reference')}) AS reviewed, count(*) FILTER ({_BLANK.format('reference')} AND NOT {_BLANK.format('text')}) AS spurious, count(*) FILTER (coalesce(review_status, 'pending') IN ('pending', '')) AS pending FROM segments WHERE quality_label = 'needs_review'",
    "q_ranking": """WITH s AS (SELECT round(quality_score, 3) AS x, quality_label = 'speech_clean' AS y FROM segments WHERE quality_score IS NOT NULL AND NOT isnan(quality_score)), r AS (SELECT *, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS k FROM s)
SELECT round(count(*) FILTER (y AND x >= 0.7) / count(*) FILTER (y)::DOUBLE, 6) AS detection, round(count(*) FILTER (NOT y AND x >= 0.7) / count(*) FILTER (NOT y)::DOUBLE, 6) AS false_alarm,
  round((sum(k) FILTER (y) - count(*) FILTER (y) * (count(*) FILTER (y) + 1) / 2.0)::DOUBLE / (count(*) FILTER (y) * count(*) FILTER (NOT y)), 6) AS auc FROM r""",
    "q_class_weights": "WITH c AS (SELECT quality_label, count(*) AS n FROM segments WHERE quality_label IS NOT NULL GROUP BY 1) SELECT quality_label, n, round(CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n), 6) AS weight FROM c",
    "q_url_canonical": "SELECT DISTINCT source_url, CASE WHEN regexp_replace(lower(regexp_extract(trim(source_url), '^https?://([^/?#]+)', 1)), '^(www\\.|m\\.|music\\.)', '') = 'clips.example' AND regexp_extract(trim(source_url), '^https?://[^/?#]+(/[^?#]*)', 1) = '/watch' THEN 'https://clips.example/watch?v=' || nullif(regexp_extract(trim(source_url), '[?&]v=([^&#\\s]+)', 1), '') END AS address FROM segments",
    "q_url_distinct": "WITH u AS (SELECT id, 'https://clips.example/watch?v=' || nullif(regexp_extract(trim(url), '[?&]v=([^&#\\s]+)', 1), '') AS address FROM pipeline_job_urls WHERE regexp_replace(lower(regexp_extract(trim(url), '^https?://([^/?#]+)', 1)), '^(www\\.|m\\.|music\\.)', '') = 'clips.example' AND regexp_extract(trim(url), '^https?://[^/?#]+(/[^?#]*)', 1) = '/watch') SELECT min(id) AS id, address FROM u WHERE address IS NOT NULL GROUP BY address",
    "q_url_states": "SELECT job_id, count(*) AS total, count(*) FILTER (status = 'completed') AS n_completed, count(*) FILTER (status = 'failed') AS n_failed, count(*) FILTER (status = 'skipped') AS n_skipped, count(*) FILTER (status = 'running') AS n_running, count(*) FILTER (status = 'queued') AS n_queued FROM pipeline_job_urls GROUP BY job_id",
    "q_progress": "SELECT job_id, CAST(greatest(0, least(100, round_even((count(*) FILTER (status IN ('completed', 'skipped', 'failed')) + 4 / 6.0::DOUBLE) / count(*) * 100, 0))) AS INT) AS percent FROM pipeline_job_urls GROUP BY job_id",
    "q_batch_status": "SELECT job_id, CASE WHEN bool_and(status = 'completed') THEN 'completed' WHEN bool_or(status = 'failed') THEN 'failed' WHEN bool_or(status = 'running') THEN 'running' WHEN bool_or(status = 'blocked') THEN 'blocked' WHEN bool_and(status = 'queued') THEN 'queued' ELSE 'running' END AS batch_status FROM pipeline_job_urls GROUP BY job_id",
    "q_active_videos": "SELECT DISTINCT video_id FROM segments WHERE trim(video_id) <> '' AND video_id IN (SELECT video_id FROM pipeline_job_urls WHERE status IN ('queued', 'running', 'completed', 'skipped'))",
    "q_unprocessed": "SELECT DISTINCT video_id FROM pipeline_job_urls WHERE trim(video_id) <> '' AND video_id NOT IN (SELECT video_id FROM segments WHERE trim(video_id) <> '')",
    "q_resume": "SELECT CASE WHEN status IN ('running', 'failed') THEN 'queued' ELSE status END AS status, count(*) AS n FROM pipeline_job_urls GROUP BY 1",
    "q_block_siblings": "WITH u AS (SELECT job_id, CASE WHEN status = 'failed' THEN 'blocked' ELSE status END AS status FROM pipeline_job_urls), b AS (SELECT DISTINCT job_id FROM u WHERE status = 'blocked') SELECT CASE WHEN status = 'queued' AND job_id IN (SELECT job_id FROM b) THEN 'blocked' ELSE status END AS status, count(*) AS n FROM u GROUP BY 1",
    "q_url_chunks": "SELECT id, (row_number() OVER (PARTITION BY job_id ORDER BY id) - 1) // 5 AS chunk_no FROM pipeline_job_urls",
    "q_numbered": "WITH s AS (SELECT DISTINCT segment_id, exported_at, review_status FROM segments WHERE segment_id IS NOT NULL) SELECT count(*) AS n, 0::BIGINT AS lo, count(*) - 1 AS hi, count(*) AS d FROM s",
    "q_query_window": "WITH p AS (SELECT p_partkey - 1 AS pos FROM part), t AS (SELECT count(*) AS n FROM p) SELECT pos, ((pos - 17) % n + n) % n AS window_idx FROM p, t WHERE ((pos - 17) % n + n) % n < 20",
    "q_stage_timings": "WITH u AS (SELECT *, CASE WHEN NOT isnan(source_duration_sec) THEN source_duration_sec END AS sec FROM pipeline_job_urls) SELECT status, logs_fail, round(coalesce(sum(sec), 0), 3) AS total_sec, count(*) AS n, round(coalesce(avg(sec), 0), 3) AS avg_sec FROM u GROUP BY 1, 2",
    "q_drill_down": "WITH u AS (SELECT *, CASE WHEN NOT isnan(source_duration_sec) THEN source_duration_sec END AS sec FROM pipeline_job_urls) SELECT coalesce(video_id, '') AS video_id, arg_min(url, id) FILTER (url IS NOT NULL) AS first_url, round(coalesce(sum(sec) FILTER (status = 'completed'), 0), 3) AS parent_sec, count(*) AS n_rows FROM u GROUP BY 1",
    "q_run_delta": "WITH o AS (SELECT strftime(o_orderdate, '%Y-%m') AS run, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2) SELECT *, n - lag(n) OVER (PARTITION BY o_orderpriority ORDER BY run) AS delta FROM o",
    "q_wav_paths": "SELECT ws_id, CASE WHEN regexp_extract(replace(wav_path, '\\', '/'), '((data/processed|segments)/.*)$', 1) <> '' THEN regexp_extract(replace(wav_path, '\\', '/'), '((data/processed|segments)/.*)$', 1) ELSE replace(wav_path, '\\', '/') END AS path FROM worksheets",
    "q_label_ids": "WITH n AS (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL AND event_type NOT IN ('click', 'view')), r AS (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS k FROM n) SELECT event_type, CAST(CASE WHEN k = 0 THEN 1 ELSE k + 2 END AS INT) AS label_id FROM r UNION ALL SELECT DISTINCT event_type, CASE event_type WHEN 'click' THEN 2 ELSE 0 END FROM events WHERE event_type IN ('click', 'view')",
    "q_error_kinds": "SELECT id, coalesce(regexp_matches(lower(logs_fail), '{rate}'), false) AS rate_limited, coalesce(regexp_matches(lower(logs_fail), '{skip}'), false) AS skippable, coalesce(regexp_matches(lower(logs_fail), '{net}'), false) AS network, coalesce(regexp_matches(logs_fail, '(?i){cookie}'), false) AS cookie, coalesce(regexp_matches(logs_fail, '(?i){auth}'), false) AS auth FROM pipeline_job_urls".format(
        rate="|".join(x.replace("'", "''") for x in fmt.RATE_LIMIT), skip="|".join(fmt.SKIPPABLE), net="|".join(fmt.NETWORK), cookie="|".join(fmt.COOKIE), auth="|".join(fmt.AUTH)
    ),
    "q_json_props": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
    "q_durations": "WITH s AS (SELECT DISTINCT duration FROM segments WHERE NOT isnan(duration)), f AS (SELECT duration, CAST(floor(duration * 100) AS BIGINT) AS s FROM s) SELECT duration, CASE WHEN s < 3600 THEN (s // 60)::VARCHAR || ':' || lpad((s % 60)::VARCHAR, 2, '0') ELSE (s // 3600)::VARCHAR || ':' || lpad((s % 3600 // 60)::VARCHAR, 2, '0') || ':' || lpad((s % 60)::VARCHAR, 2, '0') END AS clock FROM f",
}


def _distance(a: str, b: str) -> str:
    """Edit distance of two lists of up to 90 different entries: DuckDB counts bytes, so each entry becomes one."""
    code = lambda x: f"coalesce(array_to_string(list_transform({x}, lambda q: chr((35 + list_position(list_distinct(list_concat({a}, {b})), q))::INT)), ''), '')"
    return f"levenshtein({code(a)}, {code(b)})"


def _normal(c: str) -> str:
    """The compared form of a text: brackets, signs and runs of ad-libs left out."""
    plain = rf"regexp_replace(regexp_replace(lower(nfc_normalize(coalesce({c}, ''))), '[\[\(][^\]\)]*[\]\)]', ' ', 'g'), '>>+|&gt;', ' ', 'g')"
    words = rf"' ' || trim(regexp_replace(regexp_replace({plain}, '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g')) || ' '"
    return f"trim(regexp_replace({words}, ' ((na|la|oh|ohh|ooh|ooo|hey|ah|uh|yeah|wo|woah) ){{2,}}', ' ', 'g'))"


_WER = f"""WITH x AS (SELECT segment_id, arg_max(source, ws_id) AS source, arg_max({{'r': reference, 'h': hypothesis}}, ws_id) AS t FROM worksheets GROUP BY segment_id),
f AS (SELECT segment_id, source, list_filter(string_split({_normal("t['r']")}, ' '), lambda y: y <> '') AS r, list_filter(string_split({_normal("t['h']")}, ' '), lambda y: y <> '') AS h FROM x),
e AS (SELECT segment_id, source, len(r) AS n, len(h) AS m, {_distance('r', 'h')} AS e FROM f)"""
SQL["q_wer_rates"] = f"{_WER} SELECT source, count(*) FILTER (n > 0) AS n_scored, count(*) FILTER (n = 0 AND m > 0) AS n_spurious, CAST(coalesce(sum(m) FILTER (n = 0), 0) AS BIGINT) AS spurious_tokens, round(sum(e) FILTER (n > 0) / (sum(n))::DOUBLE, 6) AS micro_wer, round(avg(e / n::DOUBLE) FILTER (n > 0), 6) AS macro_wer, count(*) FILTER (n > 0 AND e = 0) AS n_exact, count(*) FILTER (n > 0 AND e / n::DOUBLE >= 0.5) AS n_bad FROM e GROUP BY source"
SQL["q_wer_worst"] = f"{_WER}, k AS (SELECT source, segment_id, e::INT AS n_errors, row_number() OVER (PARTITION BY source ORDER BY e DESC, segment_id)::INT AS rank FROM e WHERE e > 0) SELECT * FROM k WHERE rank <= 3"
SQL["q_char_distance"] = "WITH w AS (SELECT ws_id, regexp_extract_all(hypothesis, '(?s).') AS a, regexp_extract_all(reference, '(?s).') AS b FROM worksheets WHERE hypothesis IS NOT NULL AND reference IS NOT NULL) SELECT ws_id, " + _distance("a", "b") + "::INT AS distance FROM w"
SQL["q_frames"] = """WITH e AS (SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS x FROM embeddings), f AS (SELECT vec_id, x, list_transform(range(0, CAST(ceil(len(x) / 16.0) AS BIGINT)), lambda k: sqrt(list_sum(list_transform(x[k * 16 + 1 : k * 16 + 16], lambda v: v * v)) / 16)) AS r FROM e)
SELECT vec_id, round(list_avg(r), 5) AS rms, round(list_max(list_transform(x, lambda v: abs(v))), 5) AS peak, round(len(list_filter(r, lambda v: v >= 0.1)) / len(r)::DOUBLE, 5) AS active_ratio FROM f"""
# quiet or speaking, two frames to change over; frame by frame
SQL["q_voice"] = """WITH RECURSIVE f AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n, coalesce(least(1, value / 100), 0) AS p FROM events WHERE user_id IS NOT NULL),
v(user_id, n, speaking, against, told) AS (SELECT DISTINCT user_id, 0::BIGINT, false, 0, false FROM f UNION ALL
  SELECT f.user_id, f.n, CASE WHEN (f.p >= CASE WHEN speaking THEN 0.35 ELSE 0.5 END) <> speaking AND against = 1 THEN NOT speaking ELSE speaking END,
    CASE WHEN (f.p >= CASE WHEN speaking THEN 0.35 ELSE 0.5 END) <> speaking AND against = 0 THEN 1 ELSE 0 END, (f.p >= CASE WHEN speaking THEN 0.35 ELSE 0.5 END) <> speaking AND against = 1
  FROM v JOIN f ON f.user_id = v.user_id AND f.n = v.n + 1)
SELECT user_id, (row_number() OVER (PARTITION BY user_id ORDER BY n) - 1)::INT AS seq, CASE WHEN speaking THEN 'SPEAKING' ELSE 'QUIET' END AS signal_type, round(greatest(0, n * 0.032::DOUBLE - 0.064), 3) AS signal_at FROM v WHERE told"""
SQL["q_approx_videos"] = "SELECT DISTINCT transcript_source, true AS near FROM segments"
QUERIES = {k: f for k, f in globals().items() if k.startswith("q_")}
