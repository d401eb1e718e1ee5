"""Queries of cues, regions and units over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessitura.functions import formats as fmt
from tessitura.functions import text as tx
from tessitura.operators import captions, jobs, manifest, quality, regions
from tessitura.operators.dyadic import to_ms
from tessitura.runtime import table


def cues(spark: SparkSession, d: str) -> DataFrame:
    """Cues once each, the latest load of those loaded twice."""
    return jobs.latest(table(spark, d, "transcript_cues"), ["audio_id", "cue_idx"], ["loaded_at", "cue_id"])


def _timed(df: DataFrame) -> DataFrame:
    return df.withColumns({"s_ms": to_ms(F.col("start_sec")), "e_ms": to_ms(F.col("end_sec"))})


def q_clean_gate(spark, d):
    """How many texts survive cleaning, by language and gate label."""
    u = table(spark, d, "sentence_units").withColumn("clean", tx.clean_transcript(F.col("text")))
    g = quality.gate_text(F.col("clean"), F.coalesce(F.col("end_sec") - F.col("start_sec"), F.lit(0.0)))
    return u.withColumn("g", g).groupBy(F.coalesce("lang", F.lit("?")).alias("lang"), F.col("g.label").alias("label")).agg(F.count("*").alias("n"), F.count_if("g.keep").alias("n_kept"))


def q_token_gate(spark, d):
    c = cues(spark, d)
    g = quality.gate_text(F.col("text"), F.coalesce(F.col("end_sec") - F.col("start_sec"), F.lit(0.0)))
    return c.select("cue_id", g.alias("g")).select("cue_id", F.col("g.keep").alias("keep"), F.col("g.label").alias("label"), F.col("g.score").alias("score"), F.array_join("g.reasons", ",").alias("reasons"))


def q_repetition(spark, d):
    c = table(spark, d, "transcript_cues")
    return c.groupBy(F.least(tx.longest_repeat(F.col("text")), F.lit(20)).alias("run")).agg(F.count("*").alias("n"))


def q_collapse_tokens(spark, d):
    c = table(spark, d, "transcript_cues").filter(F.col("text").isNotNull())
    return c.select("cue_id", tx.collapse_repetition(F.col("text"), 1).alias("collapsed"))


def q_music_title(spark, d):
    s = table(spark, d, "segments")
    return s.groupBy(tx.is_music_title(F.col("title"), ("bản tin", "tiếng mưa")).alias("is_music")).agg(F.count("*").alias("n"))


def q_compare_form(spark, d):
    return table(spark, d, "sentence_units").select("unit_id", tx.compare_form(F.col("text")).alias("form"))


def q_wer_form(spark, d):
    w = table(spark, d, "worksheets")
    return w.select("ws_id", tx.wer_form(F.col("reference"), "raw").alias("raw_form"))


def q_strip_diacritics(spark, d):
    w = table(spark, d, "segments").select("title").distinct()
    return w.select("title", tx.strip_diacritics(F.col("title")).alias("plain"))


def q_caption_text(spark, d):
    c = table(spark, d, "transcript_cues").filter(F.col("text").isNotNull())
    return c.select("cue_id", tx.caption_text(F.col("text")).alias("plain"))


def q_merge_regions(spark, d):
    return regions.merge_regions(_timed(table(spark, d, "speech_regions")), ["audio_id"], "s_ms", "e_ms", 300)


def q_merge_speech(spark, d):
    return regions.merge_speech(_timed(table(spark, d, "speech_regions")), ["audio_id"], "s_ms", "e_ms", 200, 250)


def q_pad_regions(spark, d):
    return regions.pad_regions(_timed(table(spark, d, "speech_regions")), ["audio_id"], "s_ms", "e_ms", 100, 200, 250)


def q_tile(spark, d):
    return regions.tile(_timed(table(spark, d, "speech_regions")), ["audio_id"], "s_ms", "e_ms")


def q_silences(spark, d):
    return regions.silences(_timed(table(spark, d, "speech_regions")), ["audio_id"], "s_ms", "e_ms")


def q_chunks(spark, d):
    r = regions.chunks(_timed(table(spark, d, "speech_regions")), "s_ms", "e_ms", 2000, 300)
    return r.select("region_id", F.col("chunk_idx").cast("bigint").alias("chunk_idx"), "chunk_start_ms", "chunk_end_ms")


def _unit_rows(spark, d):
    return _timed(table(spark, d, "sentence_units")).select("audio_id", "unit_id", "s_ms", "e_ms").filter("e_ms > s_ms and audio_id is not null")


def _region_rows(spark, d):
    return _timed(table(spark, d, "speech_regions")).select("audio_id", "region_id", F.col("s_ms").alias("r_s"), F.col("e_ms").alias("r_e"))


def q_overlaps(spark, d):
    o = regions.overlaps(_unit_rows(spark, d), _region_rows(spark, d), "audio_id", ("s_ms", "e_ms"), ("r_s", "r_e"))
    return o.groupBy("unit_id").agg(F.count("*").alias("n"), F.sum(F.least("e_ms", "r_e") - F.greatest("s_ms", "r_s")).alias("overlap_ms"))


def q_align_cover(spark, d):
    return regions.align_units(_unit_rows(spark, d), _region_rows(spark, d), "audio_id", "unit_id").select("unit_id", "begin_ms", "end_ms", "vad_status")


def q_align_snap(spark, d):
    return regions.align_units(_unit_rows(spark, d), _region_rows(spark, d), "audio_id", "unit_id", "snap").select("unit_id", "begin_ms", "end_ms", "vad_status")


def q_split_long(spark, d):
    c = table(spark, d, "transcript_cues").filter("end_sec > start_sec and text is not null")
    s = captions.split_long(c, "start_sec", "end_sec", "text", 4.0)
    return s.select("cue_id", F.col("part_idx").cast("bigint").alias("part_idx"), F.round("part_start", 9).alias("part_start"), F.round("part_end", 9).alias("part_end"), "part_text")


def q_sentence_units(spark, d):
    c = cues(spark, d).filter("end_sec > start_sec")
    return captions.sentence_units(c, "audio_id", "cue_idx", "start_sec", "end_sec", "text")


def q_vtt_cues(spark, d):
    v = table(spark, d, "documents").filter(F.col("text").contains("-->")).select("doc_id", "text")
    return captions.parse_cues(v, "text").withColumns({"start": F.round("start", 6), "end": F.round("end", 6)})


def q_audio_summary(spark, d):
    parts = {n: table(spark, d, t) for n, t in (("cues", "transcript_cues"), ("regions", "speech_regions"), ("units", "sentence_units"), ("segments", "segments"))}
    return manifest.audio_summary(parts, "audio_id")


def q_window_activity(spark, d):
    from tessitura.streaming.voice import activity_windows

    return activity_windows(table(spark, d, "events"), "ts", "event_type")


def q_event_pairs(spark, d):
    e = table(spark, d, "events").withColumn("kind", F.when(F.col("value") >= 50, "SPEAKING").otherwise("QUIET"))
    return regions.pair_events(e, "user_id", "event_id", "kind", "event_id")


def _mask(spark, d):
    return table(spark, d, "events").select("user_id", "event_id", (F.coalesce("value", F.lit(0.0)) >= 50).alias("on"))


def q_mask_fill(spark, d):
    return regions.fill_short_gaps(_mask(spark, d), "user_id", "event_id", "on", 2).groupBy("user_id").agg(F.count_if("on").alias("n_on"))


def q_mask_drop(spark, d):
    return regions.drop_short_runs(_mask(spark, d), "user_id", "event_id", "on", 2).groupBy("user_id").agg(F.count_if("on").alias("n_on"))


def q_mask_hull(spark, d):
    return regions.pad_hull(_mask(spark, d), "user_id", "event_id", "on", 1).groupBy("user_id").agg(F.count_if("on").alias("n_on"))


def q_mask_segments(spark, d):
    return regions.mask_segments(_mask(spark, d), "user_id", "event_id", "on", "event_id", "event_id")


_TOK = r"list_filter(regexp_split_to_array(coalesce({}, ''), '[\s\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+'), lambda x: x <> '')"
_RUNS = "list_reduce(list_prepend([0, 0], list_transform(range(1, len(w) + 1), lambda i: [i::INT, 0])), lambda a, x: [greatest(a[1], CASE WHEN x[1] > 1 AND w[x[1]] = w[x[1] - 1] THEN a[2] + 1 ELSE 1 END), CASE WHEN x[1] > 1 AND w[x[1]] = w[x[1] - 1] THEN a[2] + 1 ELSE 1 END])[1]"
_MS = "CAST(round({} * 1000) AS BIGINT)"


def _merged(where: str, s: str, e: str, gap: int) -> str:
    return f"""
i AS (SELECT DISTINCT audio_id, {s} AS s, {e} AS e FROM speech_regions WHERE audio_id IS NOT NULL AND {where}),
m AS (SELECT *, max(e) OVER (PARTITION BY audio_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM i),
g AS (SELECT *, sum(CASE WHEN pe IS NULL OR s - pe > {gap} THEN 1 ELSE 0 END) OVER (PARTITION BY audio_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM m)"""


_S, _E = _MS.format("start_sec"), _MS.format("end_sec")
_UNITS = f"u AS (SELECT audio_id, unit_id, {_S} AS s, {_E} AS e FROM sentence_units WHERE audio_id IS NOT NULL AND {_E} > {_S}), r AS (SELECT audio_id, {_S} AS rs, {_E} AS re FROM speech_regions WHERE {_E} > {_S})"


def _align(s: str, e: str) -> str:
    return f"""WITH {_UNITS}, h AS (SELECT unit_id, min(rs) AS hs, max(re) AS he FROM u JOIN r ON u.audio_id = r.audio_id AND u.s < r.re AND r.rs < u.e GROUP BY unit_id),
a AS (SELECT u.unit_id, greatest(0, CASE WHEN hs IS NULL THEN s ELSE {s} END - 100) AS begin_ms, CASE WHEN hs IS NULL THEN e ELSE {e} END + 100 AS end_ms, CASE WHEN hs IS NULL THEN 'no_overlap' ELSE 'aligned' END AS vad_status FROM u LEFT JOIN h ON u.unit_id = h.unit_id)
SELECT * FROM a WHERE end_ms - begin_ms >= 300"""


_MASK = "m AS (SELECT user_id, event_id, coalesce(value, 0) >= 50 AS b FROM events), n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM m), k AS (SELECT *, n - row_number() OVER (PARTITION BY user_id, b ORDER BY event_id) AS run FROM n), l AS (SELECT *, count(*) OVER (PARTITION BY user_id, b, run) AS len, min(CASE WHEN b THEN n END) OVER (PARTITION BY user_id) AS f, max(CASE WHEN b THEN n END) OVER (PARTITION BY user_id) AS z FROM k)"
_GATE = """
WITH c AS (SELECT arg_max(cue_id, (loaded_at, cue_id)) AS cue_id, arg_max(coalesce(text, ''), (loaded_at, cue_id)) AS text, arg_max(coalesce(end_sec - start_sec, 0), (loaded_at, cue_id)) AS d FROM transcript_cues GROUP BY audio_id, cue_idx),
t AS (SELECT cue_id, d, len({tok}) AS n FROM c), r AS (SELECT *, n / greatest(d, 1e-6) AS q FROM t),
f AS (SELECT *, d >= 2.5 AND n < 2 AS a, q < 0.6 AS b, q > 6.0 AS c FROM r),
s AS (SELECT *, 1.0::DOUBLE - CASE WHEN a THEN 0.6::DOUBLE ELSE 0 END - CASE WHEN b THEN 0.35::DOUBLE ELSE 0 END - CASE WHEN c THEN 0.35::DOUBLE ELSE 0 END AS x FROM f)
SELECT cue_id, n > 0 AND x >= 0.5 AS keep, CASE WHEN n = 0 THEN 'low_quality' WHEN NOT (a OR b OR c) THEN 'speech_clean' WHEN x >= 0.5 THEN 'needs_review' ELSE 'low_quality' END AS label,
  CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE greatest(0.0::DOUBLE, round(x, 3)) END AS score,
  CASE WHEN n = 0 THEN 'empty_transcript' ELSE array_to_string(list_filter([CASE WHEN a THEN 'too_few_tokens_for_duration' END, CASE WHEN b THEN 'low_token_density' END, CASE WHEN c THEN 'high_token_density' END], lambda x: x IS NOT NULL), ',') END AS reasons
FROM s"""
_FORM = r"trim(regexp_replace(regexp_replace(lower(nfc_normalize({})), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"
_list = lambda xs: ", ".join("'" + x + "'" for x in xs)
_CLEAN = f"""
WITH t AS (SELECT coalesce(lang, '?') AS lang, coalesce(end_sec - start_sec, 0) AS d, text, {_FORM.format("coalesce(text, '')")} AS f, {_TOK.format('text')} AS w FROM sentence_units),
c AS (SELECT lang, d, CASE WHEN len(w) = 0 OR f IN ({_list(tx.BLOCKLIST)}) OR regexp_matches(f, '{'|'.join(tx.PROMO)}') OR {_RUNS} > 10 THEN 0 ELSE len(w) END AS n FROM t),
f AS (SELECT *, d >= 2.5 AND n < 2 AS a, n / greatest(d, 1e-6) < 0.6 AS b, n / greatest(d, 1e-6) > 6.0 AS c FROM c),
s AS (SELECT *, 1.0::DOUBLE - CASE WHEN a THEN 0.6::DOUBLE ELSE 0 END - CASE WHEN b THEN 0.35::DOUBLE ELSE 0 END - CASE WHEN c THEN 0.35::DOUBLE ELSE 0 END AS x FROM f),
l AS (SELECT lang, n > 0 AND x >= 0.5 AS keep, CASE WHEN n = 0 THEN 'low_quality' WHEN NOT (a OR b OR c) THEN 'speech_clean' WHEN x >= 0.5 THEN 'needs_review' ELSE 'low_quality' END AS label FROM s)
SELECT lang, label, count(*) AS n, count(*) FILTER (keep) AS n_kept FROM l GROUP BY 1, 2"""
SQL = {
    "q_clean_gate": _CLEAN,
    "q_compare_form": f"SELECT unit_id, {_FORM.format('text')} AS form FROM sentence_units",
    "q_wer_form": f"SELECT ws_id, {_FORM.format("coalesce(reference, '')")} AS raw_form FROM worksheets",
    "q_caption_text": r"SELECT cue_id, trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS plain FROM transcript_cues WHERE text LIKE '%<%'",
    "q_token_gate": _GATE.replace("{tok}", _TOK.format("text")),
    "q_repetition": f"WITH t AS (SELECT {_TOK.format('text')} AS w FROM transcript_cues) SELECT least(CASE WHEN len(w) = 0 THEN 0 ELSE {_RUNS} END, 20) AS run, count(*) AS n FROM t GROUP BY 1",
    "q_collapse_tokens": f"WITH t AS (SELECT cue_id, {_TOK.format('text')} AS w FROM transcript_cues WHERE text IS NOT NULL) SELECT cue_id, coalesce(array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda i: i = 1 OR w[i] <> w[i - 1]), lambda i: w[i]), ' '), '') AS collapsed FROM t",
    "q_music_title": "SELECT coalesce(regexp_matches(lower(title), 'official mv|music video|lyric|official audio| ft\\.| feat\\.|m/v|\\| official|bản tin|tiếng mưa'), false) AS is_music, count(*) AS n FROM segments GROUP BY 1",
    "q_strip_diacritics": "SELECT DISTINCT title, strip_accents(translate(title, 'đĐ', 'dD')) AS plain FROM segments",
    "q_merge_regions": f"WITH {_merged(f'{_E} > {_S}', _S, _E, 300)} SELECT audio_id, min(s) AS begin_ms, max(e) AS end_ms FROM g GROUP BY audio_id, k",
    "q_merge_speech": f"WITH {_merged(f'{_E} - {_S} >= 250', _S, _E, 200)} SELECT audio_id, min(s) AS begin_ms, max(e) AS end_ms FROM g GROUP BY audio_id, k",
    "q_pad_regions": f"WITH {_merged(f'{_E} + 100 - greatest(0, {_S} - 100) >= 250', f'greatest(0, {_S} - 100)', f'{_E} + 100', 200)} SELECT audio_id, min(s) AS begin_ms, max(e) AS end_ms FROM g GROUP BY audio_id, k",
    "q_silences": f"WITH {_merged(f'{_E} + 100 > {_S} - 100', f'{_S} - 100', f'{_E} + 100', 0)} SELECT audio_id, pe AS gap_start_ms, s AS gap_end_ms FROM g WHERE s - pe >= 32",
    "q_tile": f"WITH {_merged(f'{_E} > {_S}', _S, _E, 0)} SELECT audio_id, 'speaking' AS label, min(s) AS begin_ms, max(e) AS end_ms FROM g GROUP BY audio_id, k UNION ALL SELECT audio_id, 'quiet', coalesce(pe, 0), s FROM g WHERE s > coalesce(pe, 0)",
    "q_chunks": f"WITH r AS (SELECT region_id, {_S} AS s, {_E} AS e FROM speech_regions WHERE {_E} > {_S}), x AS (SELECT region_id, unnest(range(0, greatest(1, CAST(ceil((e - s) / 2000.0) AS BIGINT)))) AS chunk_idx, s, e FROM r) SELECT region_id, chunk_idx, s + chunk_idx * 2000 AS chunk_start_ms, least(s + chunk_idx * 2000 + 2000, e) AS chunk_end_ms FROM x WHERE least(s + chunk_idx * 2000 + 2000, e) - (s + chunk_idx * 2000) >= 300",
    "q_overlaps": f"WITH {_UNITS} SELECT unit_id, count(*) AS n, CAST(sum(least(e, re) - greatest(s, rs)) AS BIGINT) AS overlap_ms FROM u JOIN r ON u.audio_id = r.audio_id AND u.s < r.re AND r.rs < u.e GROUP BY unit_id",
    "q_align_cover": _align("greatest(hs, s - 400)", "least(he, e + 400)"),
    "q_align_snap": _align("CASE WHEN abs(hs - s) <= 400 THEN hs ELSE s END", "CASE WHEN abs(he - e) <= 400 THEN he ELSE e END"),
    "q_audio_summary": """WITH r AS (SELECT audio_id, 'c' AS p, coalesce(trim(text), '') <> '' AS t FROM transcript_cues UNION ALL SELECT audio_id, 'r', false FROM speech_regions UNION ALL SELECT audio_id, 'u', coalesce(trim(text), '') <> '' FROM sentence_units UNION ALL SELECT audio_id, 's', coalesce(trim(text), '') <> '' FROM segments)
SELECT audio_id, count(*) FILTER (p = 'c') AS n_cues, count(*) FILTER (p = 'c' AND t) AS n_cues_with_text, count(*) FILTER (p = 'r') AS n_regions, count(*) FILTER (p = 'u') AS n_units, count(*) FILTER (p = 'u' AND t) AS n_units_with_text, count(*) FILTER (p = 's') AS n_segments, count(*) FILTER (p = 's' AND t) AS n_segments_with_text FROM r WHERE audio_id IS NOT NULL GROUP BY audio_id""",
    "q_window_activity": "SELECT time_bucket(INTERVAL 5 minutes, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "q_event_pairs": "WITH e AS (SELECT user_id, event_id, CASE WHEN value >= 50 THEN 'S' ELSE 'Q' END AS k FROM events), g AS (SELECT *, coalesce(sum(CASE WHEN k = 'Q' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM e) SELECT user_id, min(event_id) FILTER (k = 'S') AS start, min(event_id) FILTER (k = 'Q') AS \"end\" FROM g GROUP BY user_id, g HAVING count(*) FILTER (k = 'S') > 0",
    "q_mask_fill": f"WITH {_MASK} SELECT user_id, count(*) FILTER (b OR (n > f AND n < z AND len <= 2)) AS n_on FROM l GROUP BY user_id",
    "q_mask_drop": f"WITH {_MASK} SELECT user_id, count(*) FILTER (b AND len >= 2) AS n_on FROM l GROUP BY user_id",
    "q_mask_hull": f"WITH {_MASK} SELECT user_id, count(*) FILTER (n BETWEEN f - 1 AND z + 1) AS n_on FROM l GROUP BY user_id",
    "q_mask_segments": f"WITH {_MASK} SELECT user_id, min(event_id) AS start, max(event_id) AS \"end\" FROM l WHERE b GROUP BY user_id, run",
    "q_split_long": f"""WITH c AS (SELECT cue_id, start_sec AS s, end_sec AS e, text, {_TOK.format('text')} AS w FROM transcript_cues WHERE end_sec > start_sec AND text IS NOT NULL),
p AS (SELECT *, CASE WHEN e - s > 4 AND len(w) > 1 THEN CAST(floor((e - s) / 4) AS BIGINT) + 1 ELSE 1 END AS n FROM c),
q AS (SELECT *, CAST(ceil(len(w) / n::DOUBLE) AS BIGINT) AS per, unnest(range(0, n)) AS part_idx FROM p)
SELECT cue_id, part_idx, round(s + part_idx * ((e - s) / n), 9) AS part_start, round(CASE WHEN n = 1 AND e - s > 4 THEN s + 4 WHEN part_idx = n - 1 THEN e ELSE s + (part_idx + 1) * ((e - s) / n) END, 9) AS part_end,
  CASE WHEN n = 1 THEN text ELSE array_to_string(w[part_idx * per + 1 : (part_idx + 1) * per], ' ') END AS part_text FROM q WHERE n = 1 OR part_idx * per < len(w)""",
}
_SPACES = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
SQL["q_caption_text"] = f"""WITH t AS (SELECT cue_id, regexp_replace(text, '<[^>]+>', ' ', 'g') AS x FROM transcript_cues WHERE text IS NOT NULL),
u AS (SELECT cue_id, replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS x FROM t) SELECT cue_id, trim(regexp_replace(x, '{_SPACES}', ' ', 'g')) AS plain FROM u"""
# blocks of lines up to a blank one; a block says what the last line of the block before it doesn't show already
SQL["q_vtt_cues"] = r"""WITH t AS (SELECT doc_id, replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS x FROM documents WHERE text LIKE '%-->%'),
b AS (SELECT doc_id, regexp_extract_all(x, '((?:\d{2}:)?\d{2}:\d{2}\.\d{3})\s+-->\s+((?:\d{2}:)?\d{2}:\d{2}\.\d{3})[^\n]*(?:\n|$)((?:[^\n]*\S[^\n]*(?:\n|$))*)') AS k FROM t),
n AS (SELECT doc_id, unnest(k) AS k, unnest(range(len(k))) AS i FROM b),
p AS (SELECT doc_id, i, regexp_extract(k, '^(\S+)', 1) AS a, regexp_extract(k, '-->\s+(\S+)', 1) AS z, list_filter(list_transform(string_split(regexp_replace(k, '^[^\n]*\n?', ''), chr(10)), lambda y: trim(regexp_replace(regexp_replace(y, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))), lambda y: y <> '') AS l FROM n),
q AS (SELECT *, list_filter(range(1, len(l) + 1), lambda j: j = 1 OR lower(l[j]) <> lower(l[j - 1])) AS keep FROM p WHERE len(l) > 0),
r AS (SELECT doc_id, i, a, z, list_transform(keep, lambda j: l[j]) AS l FROM q), s AS (SELECT *, lag(l[-1]) OVER (PARTITION BY doc_id ORDER BY i) AS shown FROM r),
w AS (SELECT *, array_to_string(CASE WHEN shown IS NOT NULL AND len(l) > 1 AND lower(l[1]) = lower(shown) THEN l[2:] ELSE l END, ' ') AS whole FROM s),
v AS (SELECT *, CASE WHEN shown IS NOT NULL AND starts_with(lower(whole), lower(shown)) AND trim(substr(whole, length(shown) + 1)) <> '' THEN trim(substr(whole, length(shown) + 1)) ELSE whole END AS said FROM w),
o AS (SELECT * FROM v WHERE shown IS NULL OR lower(said) <> lower(shown))
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INT AS cue_idx, round(list_reduce(list_prepend(0.0::DOUBLE, list_transform(string_split(a, ':'), lambda c: c::DOUBLE)), lambda m, c: m * 60 + c), 6) AS start,
  round(list_reduce(list_prepend(0.0::DOUBLE, list_transform(string_split(z, ':'), lambda c: c::DOUBLE)), lambda m, c: m * 60 + c), 6) AS "end", said AS text FROM o"""
QUERIES = {k: f for k, f in globals().items() if k.startswith("q_")}
