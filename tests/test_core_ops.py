import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessitura.functions import align, formats, text
from tessitura.operators import audio, captions, evaluate, jobs, manifest, quality, regions


def one(spark, value, kind, f):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    "f,value,want",
    [
        (text.is_blocklisted, "Cảm ơn các bạn đã theo dõi!", True),
        (text.is_blocklisted, "tôi nói: cảm ơn các bạn đã theo dõi", False),
        (text.is_blocklisted, None, False),
        (text.has_promo, "Hãy subscribe cho kênh này", True),
        (text.is_music_title, "Bài hát (Official MV)", True),
        (text.longest_repeat, "a a b b b c", 3),
        (text.longest_repeat, "", 0),
        (text.collapse_repetition, "a a a a a a a a b", "a a a a a a b"),
        (text.vlsp, "n a t o và  youtube", "nato và YouTube"),
        (text.vlsp, None, ""),
        (text.wer_form, "Xin [cười] chào, la la bạn!", "xin chào bạn"),
        (text.strip_diacritics, "Đường về", "Duong ve"),
        (text.caption_text, "a<00:00:01.000><c> b</c> &amp; c", "a b & c"),
        (text.slug, " a/b  c.", "a_b_c"),
        (text.slug, None, "unknown"),
        (text.clean_transcript, "x " * 12, ""),
        (formats.timecode, "01:02:03.5", 3723.5),
        (formats.timecode, "02:03.25", 123.25),
        (formats.timecode, "x", None),
        (formats.is_rate_limited, "HTTP Error 429", True),
        (formats.is_cookie_error, "Cookies  expired", True),
        (formats.is_auth_failure, None, False),
        (formats.video_address, "http://m.clips.example/shorts/aB1?x=2", "https://clips.example/watch?v=aB1"),
        (formats.video_address, "https://other.example/watch?v=a", None),
    ],
)
def test_scalar(spark, f, value, want):
    assert one(spark, value, "string", f) == want


def matrix(ref, hyp):
    n, m = len(ref), len(hyp)
    d = [[i + j if not i * j else 0 for j in range(m + 1)] for i in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            d[i][j] = min(d[i - 1][j - 1] + (ref[i - 1] != hyp[j - 1]), d[i - 1][j] + 1, d[i][j - 1] + 1)
    ops, i, j = [], n, m
    while i or j:
        if i and j and d[i][j] == d[i - 1][j - 1] + (ref[i - 1] != hyp[j - 1]):
            ops.append("=" if ref[i - 1] == hyp[j - 1] else "S")
            i, j = i - 1, j - 1
        elif i and d[i][j] == d[i - 1][j] + 1:
            ops.append("D")
            i -= 1
        else:
            ops.append("I")
            j -= 1
    return ops[::-1]


def test_alignment_equals_matrix():
    rng = random.Random(3)
    for _ in range(1500):
        a, b = (rng.choices("abc", k=rng.randint(0, 6)) for _ in range(2))
        ops = matrix(a, b)
        assert align.count(a, b)[:4] == tuple(ops.count(x) for x in "SDI=")
        hit = [i for i, x in enumerate(ops) if x in "=S"]
        if hit:
            ops = ops[hit[0] : hit[-1] + 1]
        assert align.count(a, b, True)[:4] == tuple(ops.count(x) for x in "SDI=")


def test_wer_columns(spark):
    rows = [("a b c", "a x c d"), ("", "oh no"), (None, None), ("a", "")]
    df = evaluate.scored(spark.createDataFrame(rows, "ref string, hyp string"), "ref", "hyp")
    got = [(tuple(r.counts)[:4], r.wer, r.flag) for r in df.collect()]
    assert got[0] == ((1, 0, 1, 2), pytest.approx(2 / 3), "")
    assert got[1][1:] == (None, "spurious") and got[2][2] == "no_ref" and got[3][0] == (0, 1, 0, 0)
    s = evaluate.summary(df.withColumn("g", F.lit(1)), ["g"]).first()
    assert s.n_scored == 2 and s.micro_wer == 0.75 and s.n_spurious == 1


def test_gates(spark):
    rows = [("xin chào các bạn nhé", 2.0), ("", 1.0), ("a", 5.0), ("a " * 30, 1.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "t string, d double").select(quality.gate_text(F.col("t"), F.col("d")).alias("g")).select("g.*")
    got = [(r.keep, r.label, r.score, r.reasons) for r in df.collect()]
    assert got[0] == (True, "speech_clean", 1.0, [])
    assert got[1] == got[4] == (False, "low_quality", 0.0, ["empty_transcript"])
    assert got[2][:2] == (False, "low_quality") and got[3] == (True, "needs_review", 0.65, ["high_token_density"])


VTT = """WEBVTT

00:00:01.000 --> 00:00:02.000 align:start
xin chào

00:00:02.000 --> 00:00:03.000
xin chào
các<00:00:02.200><c> bạn</c><00:00:02.600><c> nhé</c>

00:00:03.000 --> 00:00:04.000
các bạn nhé

"""


def test_vtt(spark):
    rolled = VTT + "00:00:05.000 --> 00:00:06.000\nCÁC bạn  nhé và &amp; cả <i>nhà</i>\nvà &amp; cả nhà\n\n10:00.500 --> 10:01.000\n\n"
    df = spark.createDataFrame([(1, VTT, 7), (2, rolled.replace("\n", "\r\n"), 7), (3, "", 7), (4, None, 7), (5, "no times", 7)], "i int, vtt string, start int")
    got = {}
    for r in captions.parse_cues(df, "vtt").orderBy("i", "cue_idx").collect():
        got.setdefault(r.i, []).append((r.start, r.end, r.text))
    two = [(1.0, 2.0, "xin chào"), (2.0, 3.0, "các bạn nhé")]
    assert got == {1: two, 2: [*two, (5.0, 6.0, "và & cả nhà và & cả nhà")]}
    assert captions.words(VTT) == [("các", 2.0, 2.2), ("bạn", 2.2, 2.6), ("nhé", 2.6, 3.0)]
    assert captions.decode("chào".encode("utf-8-sig")) == "chào"


def test_units():
    rows = [(0.0, 1.0, "xin"), (1.0, 2.0, "chào."), (2.0, 2.2, "ơ."), (9.0, 10.5, "hết")]
    assert captions.units_of_cues(rows, 0.8, 12, 1.0) == [(0.0, 2.2, "xin chào. ơ."), (9.0, 10.5, "hết")]
    words = [("a,", 0.0, 2.0), ("b", 2.0, 4.0), ("c", 4.0, 6.0), ("d.", 6.0, 7.0)]
    assert captions.units_of_words(words, 6.0, 1.0, 0.5) == [(0.0, 2.0, "a,"), (2.0, 7.0, "b c d.")]


def test_sentence_units_frame(spark):
    rows = [("x", i, s, e, t, 1) for i, (s, e, t) in enumerate([(0.0, 1.0, "xin"), (1.0, 2.0, "chào."), (9.0, 10.5, "hết"), (None, 1.0, "z"), (11.0, 12.0, None)])]
    df = spark.createDataFrame(rows, "a string, i int, s double, e double, t string, part_idx int")
    got = [tuple(r)[1:] for r in captions.sentence_units(df, "a", "i", "s", "e", "t").orderBy("unit_idx").collect()]
    assert got == [(0, 0.0, 2.0, "xin chào."), (1, 9.0, 10.5, "hết")]
    assert captions.sentence_units(df.limit(0), "a", "i", "s", "e", "t").count() == 0


def test_overlaps_equal_brute_force(spark):
    rng = random.Random(5)
    make = lambda n: [(rng.choice("ab"), i, (s := rng.randint(0, 300_000)), s + rng.randint(0, 150_000)) for i in range(n)]
    a, b = make(40), make(40)
    x, y = spark.createDataFrame(a, "e string, i int, s bigint, t bigint"), spark.createDataFrame(b, "e string, j int, u bigint, v bigint")
    got = sorted((r.i, r.j) for r in regions.overlaps(x, y, "e", ("s", "t"), ("u", "v")).collect())
    assert got == sorted((p[1], q[1]) for p in a for q in b if p[0] == q[0] and max(p[2], q[2]) < min(p[3], q[3]))


def test_manifest_upsert(spark):
    cols = "segment_id string, quality_label string, text string, reference string, manual_wer double, review_status string"
    old = spark.createDataFrame([("a", "speech_clean", "t", "ref", 0.1, "approved"), ("b", "speech_clean", "t", "", None, "")], cols)
    new = spark.createDataFrame([("a", "needs_review", "u", None, None, None), ("c", "needs_review", "v", None, None, "")], cols)
    got = {r.segment_id: tuple(r)[1:] for r in manifest.upsert(old, new, "segment_id").collect()}
    assert got["a"] == ("needs_review", "u", "ref", 0.1, "approved")
    assert got["b"][:2] == ("speech_clean", "t") and got["c"][-1] == "pending"


def test_numbered_and_labels(spark):
    df = spark.createDataFrame([(i * 7 % 101,) for i in range(101)], "x int")
    got = sorted((r.x, r.row_no) for r in jobs.numbered(df, [F.col("x")]).collect())
    assert got == [(i, i) for i in range(101)]
    names = spark.createDataFrame([(c,) for c in "dabcb"] + [(None,)], "label string")
    assert {tuple(r) for r in jobs.label_ids(names, "label", {"b": 1}).collect()} == {("b", 1), ("a", 0), ("c", 2), ("d", 3)}


def test_wav_round_trip(spark):
    samples = (np.sin(np.arange(1600)) * 9000).astype("<i2").tolist()
    df = spark.createDataFrame([(1, bytearray(audio.encode_wav(samples, 16000))), (2, bytearray(b"no wav")), (3, None)], "i int, content binary")
    rows = {r.i: r for r in audio.with_wav(df, "content").select("i", "wav.*", audio.is_clean(F.col("wav"), 16000).alias("clean"), audio.cut(F.col("wav.samples"), F.lit(16000), F.lit(0.01), F.lit(0.02)).alias("part")).collect()}
    assert rows[1].samples == samples and rows[1].clean and rows[1].part == samples[160:320]
    assert rows[2].error and not rows[2].clean and rows[3].error


def test_frames(spark):
    df = spark.createDataFrame([([1.0, -1.0, 1.0],), ([],)], "x array<double>")
    got = df.select(audio.frames(F.col("x"), 2).alias("f"), audio.metrics(audio.frames(F.col("x"), 2), 0.9).alias("m")).collect()
    assert got[0].f == [[1.0, -1.0], [1.0, 0.0]] and got[1].f == [] and got[0].m.active_ratio == 0.5 and got[0].m.peak == 1.0


def test_voice_machine():
    v = audio.Voice(audio.VoiceParams(confidence=0.5, min_volume=0.0, start_secs=0.096, stop_secs=0.064))
    got = [v.feed(p, 1.0) for p in [0, 1, 1, 0, 1, 1, 1, 0.4, 0, 1, 0, 0, 0]]
    hits = [(i, s[0], round(s[1], 3)) for i, s in enumerate(got) if s]
    assert hits == [(6, "SPEAKING", 0.128), (11, "QUIET", 0.32)]


def test_ranking_equals_pairs(spark):
    rng = random.Random(7)
    rows = [(rng.randint(0, 9) / 10, rng.randint(0, 1)) for _ in range(200)]
    r = evaluate.ranking(spark.createDataFrame(rows, "s double, l int"), "s", "l", 0.5, 101, (-0.005, 1.005)).first()
    p, n = [s for s, l in rows if l], [s for s, l in rows if not l]
    auc = sum((a > b) + (a == b) / 2 for a in p for b in n) / (len(p) * len(n))
    assert r.auc == pytest.approx(auc) and r.detection == pytest.approx(sum(a >= 0.5 for a in p) / len(p))


def test_voice_signals_of_many_recordings(spark):
    """Recordings over several batches of frames, shuffled, with NULL levels and a NULL entity, as the machine fed one by one."""
    rng = random.Random(11)
    p = audio.VoiceParams(confidence=0.5, min_volume=0.1, start_secs=0.064, stop_secs=0.064)
    rows = [(k, i, rng.choice([None, 0.1, 0.4, 0.6, 1.0]), 0.9) for k in range(40) for i in range(25_000 if k == 7 else 300)] + [(None, 0, 1.0, 0.9), (99, 0, 0.0, None)]
    want = []
    for k in range(40):
        v = audio.Voice(p)
        got = [s for r in rows if r[0] == k if (s := v.feed(r[2] or 0.0, r[3]))]
        want += [(k, i, s, round(t, 3)) for i, (s, t) in enumerate(got)]
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "e bigint, n int, p double, v double").repartition(3)
    assert sorted((*r[:3], round(r[3], 3)) for r in audio.voice_signals(df, "e", "n", "p", "v", p).collect()) == want
    assert audio.voice_signals(df.limit(0), "e", "n", "p", "v", p).count() == 0
    nan = spark.createDataFrame([("a", i, x, 0.9) for i, x in enumerate([1.0, 1.0, float("nan"), float("nan")])], "e string, n int, p double, v double")
    assert [r.signal_type for r in audio.voice_signals(nan, "e", "n", "p", "v", p).collect()] == ["SPEAKING", "QUIET"]
