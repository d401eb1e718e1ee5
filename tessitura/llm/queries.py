"""Queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessitura.llm import canonical, leaks, mixing, mojibake, residue, runs, sentences, splits
from tessitura.runtime import table

#: Splits that can be told apart; more raise an error.
MAX_SPLITS = 1_000


def _cue_runs(spark: SparkSession, d: str, least: int) -> DataFrame:
    cues = table(spark, d, "transcript_cues")
    return runs.collapse_runs(cues, "audio_id", "cue_idx", "text", "start_sec", "end_sec", ["loaded_at", "cue_id"], least)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _cue_runs(spark, d, 2).select("audio_id", "first_idx", "last_idx")


def p1_collapsed(spark: SparkSession, d: str) -> DataFrame:
    return _cue_runs(spark, d, 1)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.find_garbled(table(spark, d, "transcript_cues"), "cue_id", "text").select("cue_id")


def p4_restored(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.find_garbled(table(spark, d, "transcript_cues"), "cue_id", "text")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    cues, units = table(spark, d, "transcript_cues"), table(spark, d, "sentence_units")
    sent = spark.sparkContext.broadcast(mojibake.fit(cues, "text"))

    def garbled():
        many = mojibake.repairer(*sent.value)
        return lambda texts, odd: many([t if o else None for t, o in zip(texts, odd)])[0]

    of_units = sentences.sentence_ends(units, "unit_id", "text", lang="lang").select(F.lit("unit").alias("src"), F.col("unit_id").alias("row_id"), "end_pos")
    of_cues = sentences.sentence_ends(cues, "cue_id", "text", garbled).select(F.lit("cue").alias("src"), F.col("cue_id").alias("row_id"), "end_pos")
    return of_units.unionByName(of_cues)


def p2_sentences(spark: SparkSession, d: str) -> DataFrame:
    cues, units = table(spark, d, "transcript_cues"), table(spark, d, "sentence_units")
    of_units = sentences.sentence_units(units, "unit_id", "text", lang="lang").select(F.lit("unit").alias("src"), F.col("unit_id").alias("row_id"), "sentence_idx", "sentence")
    of_cues = sentences.sentence_units(cues, "cue_id", "text").select(F.lit("cue").alias("src"), F.col("cue_id").alias("row_id"), "sentence_idx", "sentence")
    return of_units.unionByName(of_cues)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = splits.tied_pairs(table(spark, d, "segments"), splits.recording_keys())
    return pairs.select(F.col("a").alias("video_a"), F.col("b").alias("video_b"))


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    return splits.groups(table(spark, d, "segments"), splits.recording_keys()).select(F.col("id").alias("video_id"), F.col("group_id").alias("group_video"))


def _split(spark: SparkSession, d: str) -> DataFrame:
    named = table(spark, d, "split_targets").filter(F.col("target_share") > 0).orderBy("split_name").limit(MAX_SPLITS + 1).collect()
    if len(named) > MAX_SPLITS:
        raise ValueError(f"more than {MAX_SPLITS} splits")
    targets = [(r["split_name"], r["target_share"]) for r in named]
    return splits.assign_splits(table(spark, d, "segments"), splits.recording_keys(), F.col("quality_label"), targets)


def p5_splits(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d)


def p5_shares(spark: SparkSession, d: str) -> DataFrame:
    s = _split(spark, d).groupBy("split_name", "quality_label").agg(F.count("*").alias("n"))
    from pyspark.sql import Window

    return s.withColumn("share_of_label", F.col("n") / F.sum("n").over(Window.partitionBy("quality_label")))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.different_forms(table(spark, d, "worksheets"), "ws_id", ["hypothesis", "reference"])


def p6_canonical(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "worksheets").select("ws_id", "hypothesis", "reference")
    return canonical.canonical_columns(w, ["hypothesis", "reference"])


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leaks.find_leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).filter(F.col("longest_run") >= 12).select("doc_id", "item_id")


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d)


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets")).select("doc_id", "source", "copy", "mix_key", "text")


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.find_residue(table(spark, d, "documents"), "doc_id", "text").select("doc_id")


def p9_clean(spark: SparkSession, d: str) -> DataFrame:
    return residue.without_residue(table(spark, d, "documents"), "doc_id", "text")


QUERIES = {
    "p1_found": p1_found,
    "p1_collapsed": p1_collapsed,
    "p2_found": p2_found,
    "p2_sentences": p2_sentences,
    "p4_found": p4_found,
    "p4_restored": p4_restored,
    "p5_found": p5_found,
    "p5_groups": p5_groups,
    "p5_splits": p5_splits,
    "p5_shares": p5_shares,
    "p6_found": p6_found,
    "p6_canonical": p6_canonical,
    "p7_found": p7_found,
    "p7_report": p7_report,
    "p8_mixture": p8_mixture,
    "p8_shares": p8_shares,
    "p9_found": p9_found,
    "p9_clean": p9_clean,
}
SQL: dict[str, str] = {
    # the ties of segments, by a recursive walk from every video
    "p5_found": """
WITH RECURSIVE r AS (
  SELECT DISTINCT CASE WHEN trim(video_id) <> '' THEN 'v:' || video_id END AS v, CASE WHEN trim(audio_id) <> '' THEN 'a:' || audio_id END AS a,
    CASE WHEN trim(segment_id) <> '' THEN 's:' || segment_id END AS s, 'k:' || nullif(regexp_extract(source_url, '[?&;]v=([^&#;\\s]+)', 1), '') AS k
  FROM segments),
k AS (SELECT row_number() OVER () AS id, v, a, s, k FROM r),
t AS (SELECT id, unnest([v, a, s, k]) AS t FROM k), m AS (SELECT DISTINCT id, t FROM t WHERE t IS NOT NULL),
e AS (SELECT t, min(id) AS lo FROM m GROUP BY t HAVING min(id) < max(id)),
g AS (SELECT DISTINCT m.id AS x, e.lo AS y FROM m JOIN e USING (t) WHERE m.id <> e.lo),
b AS (SELECT x, y FROM g UNION SELECT y, x FROM g),
w(x, y) AS (SELECT id, id FROM k WHERE v IS NOT NULL UNION SELECT w.x, b.y FROM w JOIN b ON w.y = b.x),
c AS (SELECT x, min(y) AS root FROM w GROUP BY x),
n AS (SELECT DISTINCT c.root, substr(k.v, 3) AS v FROM c JOIN k ON c.x = k.id)
SELECT a.v AS video_a, b.v AS video_b FROM n a JOIN n b ON a.root = b.root AND a.v < b.v""".replace("\\\\", "\\"),
    "p5_groups": """
WITH RECURSIVE r AS (
  SELECT DISTINCT CASE WHEN trim(video_id) <> '' THEN 'v:' || video_id END AS v, CASE WHEN trim(audio_id) <> '' THEN 'a:' || audio_id END AS a,
    CASE WHEN trim(segment_id) <> '' THEN 's:' || segment_id END AS s, 'k:' || nullif(regexp_extract(source_url, '[?&;]v=([^&#;\\s]+)', 1), '') AS k
  FROM segments),
k AS (SELECT row_number() OVER () AS id, v, a, s, k FROM r),
t AS (SELECT id, unnest([v, a, s, k]) AS t FROM k), m AS (SELECT DISTINCT id, t FROM t WHERE t IS NOT NULL),
e AS (SELECT t, min(id) AS lo FROM m GROUP BY t HAVING min(id) < max(id)),
g AS (SELECT DISTINCT m.id AS x, e.lo AS y FROM m JOIN e USING (t) WHERE m.id <> e.lo),
b AS (SELECT x, y FROM g UNION SELECT y, x FROM g),
w(x, y) AS (SELECT id, id FROM k WHERE v IS NOT NULL UNION SELECT w.x, b.y FROM w JOIN b ON w.y = b.x),
c AS (SELECT x, min(y) AS root FROM w GROUP BY x),
n AS (SELECT DISTINCT c.root, substr(k.v, 3) AS v FROM c JOIN k ON c.x = k.id)
SELECT v AS video_id, min(v) OVER (PARTITION BY root) AS group_video FROM n""".replace("\\\\", "\\"),
    # every run of twelve words of an item, looked up among those of the documents
    "p7_found": r"""
WITH x AS (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM eval_items),
p AS (SELECT side, id, regexp_replace(regexp_replace(text, '(?m)^(\d+[ \t]*\r?\n)?[ \t]*(\d{1,2}:)?\d{1,2}:\d{2}[.,]\d{1,3}\s*-->[^\n]*$|\d{1,2}:\d{2}:\d{2}([.,]\d+)?|\[\d{1,2}:\d{2}([.,]\d+)?\]', ' ', 'g'), '<[^<>\n]*>|\{\\[^{}]*\}', '', 'g') AS t FROM x WHERE text IS NOT NULL),
w AS (SELECT side, id, regexp_extract_all(replace(lower(strip_accents(t)), 'đ', 'd'), '[\p{Han}\p{Hiragana}\p{Katakana}]|[\p{L}\p{N}]+') AS w FROM p),
g AS (SELECT DISTINCT side, id, array_to_string(w[k : k + 11], ' ') AS g FROM (SELECT side, id, w, unnest(range(1, len(w) - 10)) AS k FROM w WHERE len(w) >= 12))
SELECT DISTINCT d.id AS doc_id, i.id AS item_id FROM g d JOIN g i USING (g) WHERE d.side = 'd' AND i.side = 'i'""",
    # neighbours compared one by one; each character becomes a byte, as DuckDB counts edits in bytes
    "p1_found": r"""
WITH c AS (SELECT audio_id, cue_idx::BIGINT AS i, arg_max(coalesce(text, ''), (loaded_at, cue_id)) AS text FROM transcript_cues WHERE audio_id IS NOT NULL AND cue_idx IS NOT NULL GROUP BY ALL),
n AS (SELECT audio_id, i, regexp_replace(regexp_replace(regexp_replace(nfc_normalize(text), '<[^<>]*>', '', 'g'), '(\p{N})[^\p{L}\p{M}\p{N}]+(\p{N})', '\1' || chr(1) || '\2', 'g'), '(\p{N})[^\p{L}\p{M}\p{N}\x01]+(\p{N})', '\1' || chr(1) || '\2', 'g') AS x FROM c),
k AS (SELECT audio_id, i, nullif(lower(regexp_replace(x, '[^\p{L}\p{M}\p{N}\x01]+', '', 'g')), '') AS k FROM n),
p AS (SELECT *, lag(k) OVER (PARTITION BY audio_id ORDER BY i) AS b FROM k),
l AS (SELECT *, CASE WHEN k IS NOT NULL AND b IS NOT NULL AND k <> b AND abs(length(k) - length(b)) <= 1 THEN regexp_extract_all(k, '(?s).') END AS u, CASE WHEN k <> b THEN regexp_extract_all(b, '(?s).') END AS v FROM p),
s AS (SELECT audio_id, i, k IS NOT NULL AND (coalesce(k = b, false) OR coalesce(regexp_extract_all(k, '\p{N}+') = regexp_extract_all(b, '\p{N}+')
  AND damerau_levenshtein(array_to_string(list_transform(u, lambda q: chr((35 + list_position(list_distinct(list_concat(u, v)), q))::INT)), ''), array_to_string(list_transform(v, lambda q: chr((35 + list_position(list_distinct(list_concat(u, v)), q))::INT)), '')) <= 1, false)) AS same FROM l),
g AS (SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY audio_id ORDER BY i) AS g FROM s)
SELECT audio_id, min(i) AS first_idx, max(i) AS last_idx FROM g GROUP BY audio_id, g HAVING count(*) >= 2""",
}
