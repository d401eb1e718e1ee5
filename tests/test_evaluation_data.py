"""Alignment, reports, frames, selections, segments and exports on small fixtures, with NULLs, ties and empty tables."""

import random

import pytest
from pyspark.sql import functions as F

from tessitura.functions import align
from tessitura.operators import audio, exports, frames, jobs, regions, reports, segments, select


def matrix(ref, hyp):
    """All costs, and the way back with ties to the diagonal, then a deletion."""
    d = [[i + j if not i * j else 0 for j in range(len(hyp) + 1)] for i in range(len(ref) + 1)]
    for i in range(1, len(ref) + 1):
        for j in range(1, len(hyp) + 1):
            d[i][j] = min(d[i - 1][j - 1] + (ref[i - 1] != hyp[j - 1]), d[i - 1][j] + 1, d[i][j - 1] + 1)
    i, j, out = len(ref), len(hyp), []
    while i or j:
        if i and j and d[i][j] == d[i - 1][j - 1] + (ref[i - 1] != hyp[j - 1]):
            i, j = i - 1, j - 1
            out.append("EQUAL" if ref[i] == hyp[j] else "SUB")
        elif i and d[i][j] == d[i - 1][j] + 1:
            i -= 1
            out.append("DEL")
        else:
            j -= 1
            out.append("INS")
    return out[::-1]


def test_operations_equal_a_matrix():
    rng = random.Random(1)
    for _ in range(300):
        ref, hyp = (rng.choices("abcd", k=rng.randint(0, 14)) for _ in range(2))
        ops = align.operations(ref, hyp)
        assert [o[0] for o in ops] == matrix(ref, hyp)
        assert [o[1] for o in ops if o[1] is not None] == ref and [o[2] for o in ops if o[2] is not None] == hyp
        assert all(ref[o[3]] == o[1] for o in ops if o[3] is not None) and all(hyp[o[4]] == o[2] for o in ops if o[4] is not None)


def test_counts_of_operations_and_lines(spark):
    rows = [(1, list("abcd"), list("xbcdy")), (2, [], list("ab")), (3, list("ab"), None), (4, list("ab"), list("xyz")), (5, list("zabz"), list("ab"))]
    df = spark.createDataFrame(rows, "i int, r array<string>, h array<string>").withColumn("o", align.aligned_ops(F.col("r"), F.col("h")))
    for windowed in (False, True):
        got = df.select("i", align.counts_of(F.col("o"), windowed).alias("a"), align.aligned(F.col("r"), F.col("h"), windowed).alias("b")).collect()
        assert all(tuple(r.a) == tuple(r.b) for r in got)
    lines = df.filter("i = 1").select(align.shown(F.col("o")).alias("l")).head().l.split("\n")
    assert lines[0] == "REF: a b c d *" and lines[1] == "HYP: x b c d y" and lines[2].startswith("     S") and lines[2].endswith("I")


def test_drafts(spark):
    segs = [("v", "s1", "xin chào các"), ("v", "s2", "bạn nhé"), ("v", "s3", None), ("w", "s4", "a b"), ("x", "s5", None)]
    lyr = [("v", "[Verse] Xin chào, cả các bạn! Nhé…"), ("x", "la la")]
    s = spark.createDataFrame(segs, "video string, seg string, text string")
    out = {r.seg: (r.draft, r.rate) for r in reports.drafts(s, spark.createDataFrame(lyr, "video string, lyric string"), "video", "seg", "seg", "text").collect()}
    assert out == {"s1": ("Xin chào cả các", 1.0), "s2": ("bạn Nhé", 1.0), "s3": ("", None), "s4": ("", None), "s5": ("", None)}
    assert reports.drafts(s.limit(0), spark.createDataFrame(lyr, "video string, lyric string"), "video", "seg", "seg", "text").count() == 0


def test_references_details_and_sheets(spark):
    w = spark.createDataFrame([("a", "f", None, 0, None, 1), ("b", "f", " ", 0, None, 2), ("c", "g", "có", 1, 0.3, 3), ("c", "g", "x", 1, 0.3, 4), (" ", "g", "y", 1, None, 5), (None, "g", "y", 1, None, 6)], "k string, f string, reference string, auto int, match_rate double, n int")
    assert {r.k: r.reference for r in reports.references(w, "k", "reference", "n").collect()} == {"a": "", "b": " ", "c": "x"}
    d = spark.createDataFrame([("a", "mới", 0.5), ("c", "mới", 0.5)], "k string, draft string, rate double")
    got = {r.n: (r.reference, r.auto, r.match_rate) for r in reports.filled_in(w, d, "f", "k").collect()}
    assert got[1] == ("mới", 1, 0.5) and got[2] == (" ", 0, None) and got[3] == ("có", 1, 0.3) and len(got) == 6
    s = spark.createDataFrame([("a", "Xin chào"), ("b", None), ("z", "la")], "k string, text string")
    r = spark.createDataFrame([("a", "xin, CHÀO bạn"), ("b", "nhạc nền")], "k string, reference string")
    got = {x.k: (x.n_ref, x.D, x.wer, x.flag) for x in reports.detail(s, r, "k", "text").collect()}
    assert got == {"a": (3, 1, "0.3333", ""), "b": (0, 0, "", "no_ref"), "z": (0, 0, "", "spurious")}


def test_document_scores(spark):
    s = spark.createDataFrame([("d", 2, "c d"), ("d", 1, "a b"), ("d", 3, None), ("e", 1, "x")], "doc string, n int, t string")
    r = spark.createDataFrame([("d", "a b c"), ("f", "q")], "doc string, reference string")
    got = [(x.doc, tuple(x.words), x.characters.ins) for x in reports.document_scores(s, r, "doc", "n", "t").collect()]
    assert got == [("d", (0, 0, 1, 3, 3, 4), 1)]


def test_frames_labels_and_energy(spark):
    n = spark.createDataFrame([("a", 4), ("b", 2), ("c", 0)], "e string, n int")
    r = spark.createDataFrame([("a", 0, 20), ("a", 30, 50), ("a", 40, 90), ("b", None, 5), ("b", 9, 3), ("z", 0, 9)], "e string, s int, t int")
    got = {(x.e, x.frame_idx): x.label for x in frames.labelled_frames(n, r, "e", "n", "s", "t", 32).collect()}
    assert got == {("a", 0): 1, ("a", 1): 1, ("a", 2): 1, ("a", 3): 0, ("b", 0): 0, ("b", 1): 0}
    levels = [("a", i, 0.5 if 5 <= i < 10 or i == 12 else 0.001) for i in range(30)] + [("b", i, 0.0) for i in range(5)]
    got = [tuple(x) for x in frames.energy_regions(spark.createDataFrame(levels, "e string, f int, rms double"), "e", "f", "rms").collect()]
    assert got == [("a", 96, 480)]
    rough = spark.createDataFrame([("a", 1, 1000, 2000), ("a", 2, 5000, 5100), ("a", 3, 9000, 9900)], "e string, k int, s_ms long, e_ms long")
    loud = spark.createDataFrame([("a", 900, 1200), ("a", 1500, 2300), ("a", 4000, 4600)], "e string, r_s long, r_e long")
    assert sorted(tuple(x) for x in frames.refined(rough, loud, "e", "k").collect()) == [("a", 900, 2300), ("a", 4000, 4600)]


def test_tiles_of_whole_recordings(spark):
    d = spark.createDataFrame([("a", 1000), ("b", 500)], "e string, duration_ms long")
    r = spark.createDataFrame([("a", -50, 100), ("a", 400, 2000), ("c", 10, 20), ("a", None, 5)], "e string, s long, t long")
    got = sorted(tuple(x) for x in regions.tile(r, ["e"], "s", "t", d).collect())
    assert got == [("a", "quiet", 100, 400), ("a", "speaking", 0, 100), ("a", "speaking", 400, 1000), ("b", "quiet", 0, 500), ("c", "quiet", 0, 10), ("c", "speaking", 10, 20)]
    got = sorted(tuple(x) for x in regions.silences(r, ["e"], "s", "t", 50, 32, d).collect())
    assert ("b", 0, 500) in got and ("a", 150, 350) in got
    ev = spark.createDataFrame([("a", 0, "SPEAKING", -0.1), ("a", 1, "QUIET", 0.4), ("a", 2, "SPEAKING", 0.9), ("b", 0, "SPEAKING", 7.0)], "e string, n int, k string, at double")
    got = sorted(tuple(x) for x in regions.pair_events(ev, "e", "n", "k", "at", d.select("e", (F.col("duration_ms") / 1000).alias("duration"))).collect())
    assert got == [("a", 0.0, 0.4), ("a", 0.9, 1.0)]


def test_frames_of_signals(spark):
    sig = spark.createDataFrame([("a", [float(i) for i in range(10)])], "e string, x array<double>")
    reg = spark.createDataFrame([("a", 0.0, 0.5), ("a", 0.9, 2.0), ("a", 0.2, 0.3)], "e string, start double, end double")
    got = [(r.start_at, r.frame_idx, r.frame, r.label) for r in frames.region_frames(sig, reg, "e", "x", 10, 1, 4).orderBy("start_at", "frame_idx").collect()]
    assert got == [(0, 0, [0.0, 1.0, 2.0, 3.0], 1), (0, 1, [4.0, 0.0, 0.0, 0.0], 1)]
    assert frames.all_speech(sig, "e", "x", 4).count() == 3


def test_volume():
    import numpy as np

    t = np.arange(16000) / 16000
    full = frames.loudness(np.sin(2 * np.pi * 997 * t), 16000)
    assert abs(full + 3.01) < 0.3 and frames.loudness(np.zeros(10), 16000) == -np.inf == frames.loudness(np.array([]), 16000)
    assert abs(frames.loudness(0.1 * np.sin(2 * np.pi * 997 * t), 16000) - full + 20) < 0.01


def test_smoothing_splits_and_draws(spark):
    x = spark.createDataFrame([("a", i, 1.0) for i in range(200)] + [("b", 0, None)], "e string, n int, v double")
    got = {(r.e, r.n): r.smoothed for r in frames.smoothed(x, "e", "n", "v").collect()}
    assert got[("a", 0)] == pytest.approx(0.2) and got[("a", 1)] == pytest.approx(0.36) and got[("a", 199)] == pytest.approx(1, abs=1e-5) and got[("b", 0)] == 0
    ids = spark.range(20_000)
    assert frames.shuffle_split(ids, "id", 0.25).filter("split = 'val'").count() == pytest.approx(5000, abs=200)
    d = frames.drawn(ids, "id", F.when(F.col("id") < 100, 100.0).otherwise(1.0), 10_000, 29_900.0)
    r = d.agg(F.sum("draws"), F.sum(F.when(F.col("id") < 100, F.col("draws")))).head()
    assert r[0] == pytest.approx(10_000, rel=0.05) and r[1] == pytest.approx(3344, rel=0.1)
    both = frames.with_source({"p": spark.createDataFrame([(1,)], "a int"), "q": spark.createDataFrame([(2, "x")], "a int, source string")})
    assert sorted(tuple(r) for r in both.collect()) == [(1, "p"), (2, "q")]


def test_selections(spark):
    x = spark.createDataFrame([(i, f"k{i % 7}", float(i % 5), f"q{i % 3}") for i in range(30)], "i int, k string, s double, q string")
    assert [r.i for r in select.newest(x, "s", "i", 2).collect()] == [29, 24] and select.newest(x, "s", "i", 0).count() == 1
    assert [r.row_no for r in select.sliced(x, [F.col("i")], 3, 6).orderBy("row_no").collect()] == [3, 4, 5] and select.sliced(x, [F.col("i")], 28).count() == 2
    q = select.within_quota(x, "q", "k", "s", 4, 3, spark.createDataFrame([("k0",), (None,)], "k string")).collect()
    assert len({r.k for r in q}) == len(q) <= 4 and all(r.s > 0 and r.k != "k0" for r in q)
    h = spark.createDataFrame([(1, t, s) for t, s in enumerate(["v", "a", "a", "b", "v", "v"])], "j int, t int, s string")
    assert [(r.t, r.run_no, r.ended_at) for r in select.step_history(h, "j", "t", "s", "v").orderBy("t").collect()] == [(0, 1, 1), (1, 1, 3), (3, 1, 4), (4, 2, 5), (5, 3, None)]
    v = spark.createDataFrame([("a;\n b ;;", '{"cursor": 7}', " 1.5 ", "http://u:p@h:80/x"), (None, "no", "x", None)], "a string, b string, c string, d string")
    got = [tuple(r) for r in v.select(select.listed(F.col("a")), select.cursor(F.col("b")), select.number(F.col("c")), select.host_label(F.col("d"))).collect()]
    assert got == [(["a", "b"], 7, 1.5, "http://h:80"), ([], 0, None, "invalid")]


def test_segment_rows(spark):
    u = spark.createDataFrame([("a", 1, 1000, 3000, "xin chào các bạn nhé"), ("a", 2, 5000, 6000, "hãy đăng ký kênh"), ("b", 3, 0, 900, None), ("b", 4, 0, 50, "x")], "audio_id string, unit_id int, s_ms long, e_ms long, text string")
    r = spark.createDataFrame([("a", 900, 3200), ("z", 0, 9)], "audio_id string, r_s long, r_e long")
    i = spark.createDataFrame([("a", "v", "t", "u")], "audio_id string, video_id string, title string, source_url string")
    rows = segments.segment_rows(u, r, i)
    got = {x.segment_id: (x.start_sec, x.text, x.transcript_status, x.vad_status, x.quality_label, x.video_id) for x in rows.collect()}
    assert got == {"a_00000": (0.8, "xin chào các bạn nhé", "ready", "aligned", "speech_clean", "v"), "a_00001": (4.9, "", "missing", "no_overlap", "low_quality", "v"), "b_00000": (0.0, "", "missing", "no_overlap", "low_quality", None)}
    out = segments.outputs(rows)
    assert {x.audio_id: (x.n_segments, x.n_missing) for x in out["summary"].collect()} == {"a": (2, 1), "b": (1, 1)} and out["missing"].count() == 2
    assert tuple(out["totals"].head()) == (2, 3, 2) and segments.segment_rows(u.limit(0), r, i).count() == 0


def test_exports(spark):
    t = spark.createDataFrame([(1, "  xin  chào bạn"), (2, "")], "k int, text string")
    s = spark.createDataFrame([(1, 2, 9, "NAME")], "k int, start int, end int, label string")
    lines = [r.line for r in exports.conll_lines(exports.bio_tokens(t, s, "k", "text"), "k").orderBy("k", "line_no").collect()]
    assert lines == ["xin -X- _ B-NAME", "chào -X- _ I-NAME", "bạn -X- _ O", ""]
    p = spark.createDataFrame([([(0.0, 0.0), (4.0, 0.0), (4.0, 3.0)],)], "p array<struct<x:double,y:double>>")
    r = p.select(exports.shoelace(F.col("p")).alias("a"), exports.polygon_box(F.col("p")).alias("b")).head()
    assert r.a == 6 and tuple(r.b) == (0, 0, 4, 3)
    b = spark.createDataFrame([("i1", "cat", 10.0, 10.0, 50.0, 50.0), ("i0", "a<b", 0.0, 0.0, 10.0, 10.0)], "image string, label string, x double, y double, w double, h double").withColumns({"width": F.lit(100), "height": F.lit(200), "degrees": F.lit(None).cast("double")})
    c = exports.coco_rows(b, "image", "label")
    assert [tuple(r) for r in c["annotations"].orderBy("id").select("image_id", "category_id", "area").collect()] == [(0, 0, 200.0), (1, 1, 5000.0)]
    x = {r.image: r.content for r in exports.voc_xml(exports.corner_boxes(b), "image", "label").collect()}
    assert "<name>a&lt;b</name>" in x["i0"] and "<xmin>10</xmin><ymin>20</ymin><xmax>60</xmax><ymax>120</ymax>" in x["i1"]
    v = spark.createDataFrame([("plain",), ('{"text": ["one", "two"]}',), (None,)], "v string")
    assert [r[0] for r in v.select(exports.said(F.col("v"))).collect()] == ["plain", "one", None]


def test_wav_reading(spark):
    import io
    import wave

    def made(width, channels, rate, data):
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(channels), w.setsampwidth(width), w.setframerate(rate), w.writeframes(data)
        return out.getvalue()

    rows = [(1, made(2, 1, 16000, b"\x00\x40" * 4)), (2, made(2, 2, 16000, b"\x00\x40\x00\x00" * 4)), (3, made(1, 1, 16000, b"\xff\x80")), (4, made(2, 1, 8000, b"\x00\x40")), (5, b"x"), (6, None)]
    df = spark.createDataFrame(rows, "i int, content binary")
    strict = {r.i: r.wav.error is None for r in audio.with_wav(df, "content").collect()}
    assert strict == {1: True, 2: False, 3: False, 4: True, 5: False, 6: False}
    loose = {r.i: r.x for r in audio.with_wav(df, "content", mono=False, strict=False, rate=16000).select("i", audio.as_float(F.col("wav.samples")).alias("x")).collect()}
    assert loose[1] == [0.5] * 4 and loose[2] == [0.25] * 4 and loose[3] == [127 / 128, 0.0] and loose[4] is loose[5] is loose[6] is None


def test_numbers_survive_many_ties(spark):
    x = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    got = sorted(r.row_no for r in jobs.numbered(x, [F.col("k"), F.col("id")]).collect())
    assert got == list(range(1000))
    assert {r.label_id for r in jobs.label_ids(x.select(F.col("id").cast("string").alias("l")), "l", {"5": 3}).collect()} == set(range(1000))
    assert regions.chunks(spark.createDataFrame([], "s long, e long"), "s", "e", 10, 1).count() == 0


def test_frames_of_recordings_longer_than_an_int_of_milliseconds(spark):
    """Frames beyond 2^31 ms, regions over many blocks and at their borders, against a comparison of every pair."""
    import random

    rng = random.Random(2)
    big = 2_600_000
    n = spark.createDataFrame([("long", big), ("a", 200), ("b", 64), ("c", None), (None, 2)], "e string, n bigint")
    spans = [(e, s, s + rng.choice([1, 500, 700, 70_000, 130_000])) for e, top in (("a", 200_000), ("b", 70_000)) for s in rng.sample(range(-900, top), 12)] + [("a", 7, None), (None, 0, 2000)]
    far = [("long", (big - 70) * 1000, (big - 1) * 1000 + 500), ("long", 63_500, 64_500)]
    out = frames.labelled_frames(n, spark.createDataFrame(spans + far, "e string, s bigint, t bigint"), "e", "n", "s", "t", 1000).cache()
    got = {(r.e, r.frame_idx): r.label for r in out.filter("e is null or e <> 'long'").collect()}
    on = lambda e, i: int(any(k == e and t and min(t, i * 1000 + 1000) - max(s, i * 1000) >= 500 for k, s, t in spans))
    assert got == {(e, i): on(e, i) if e else 0 for e, m in (("a", 200), ("b", 64), (None, 2)) for i in range(m)}
    assert out.filter("e = 'long'").agg(F.count("*"), F.count_distinct("frame_idx"), F.max("frame_idx"), F.sum("label")).head()[:] == (big, big, big - 1, 72)


def test_long_alignments_equal_a_matrix():
    """Bands that are too narrow at first, ties at their edges, and 40,000 words without, or with a few, differences."""
    rng = random.Random(3)
    for _ in range(60):
        ref = rng.choices("abcde", k=rng.randint(0, 120))
        hyp = rng.choice([rng.choices("abcde", k=rng.randint(0, 120)), [w for w in ref if rng.random() > 0.1], ref[:20] + ref[60:], ref[30:] + ref[:30]])
        ops = [o[0] for o in align.operations(ref, hyp)]
        assert ops == matrix(ref, hyp)
        last, want = -1, []
        for o in ops:
            last += o != "DEL"
            if o != "INS":
                want.append(max(last, 0) if o == "EQUAL" else -1 - max(last, 0))
        assert align.places(ref, hyp) == want
    words = [str(i % 9973) for i in range(40_000)]
    assert not align.path(words, words).any()
    some = [w for i, w in enumerate(words) if i not in (9, 20_000, 39_990)]
    assert align.count(words, some) == (0, 3, 0, 39_997, 40_000, 39_997)


def test_drafts_of_one_long_video_stay_linear(spark):
    """600 segments of 20 words, and a lyric with a word more than is heard."""
    segs = [("v", f"s{i:04}", " ".join(f"w{i}x{j}" for j in range(20))) for i in range(600)]
    s = spark.createDataFrame(segs, "video string, seg string, text string")
    lyric = spark.createDataFrame([("v", " ".join(t for _, _, t in segs) + " thêm")], "video string, lyric string")
    out = reports.drafts(s, lyric, "video", "seg", "seg", "text")
    got = {r.seg: (r.draft, r.rate) for r in out.collect()}
    assert got == {k: (t + " thêm" * (k == "s0599"), 1.0) for _, k, t in segs}


def test_voiced_tiles_of_many_recordings(spark):
    """Tiles fill every recording, one of them over several batches of frames."""
    rng = random.Random(5)
    n = {k: 12_000 if k == 3 else 60 for k in range(12)}
    rows = [(k, i, float(rng.random() < 0.5), 0.9) for k, m in n.items() for i in range(m)]
    d = spark.createDataFrame([(k, m * 32) for k, m in n.items()], "e bigint, duration_ms bigint")
    p = audio.VoiceParams(confidence=0.5, min_volume=0.1, start_secs=0.064, stop_secs=0.064)
    t = regions.voiced_tiles(spark.createDataFrame(rows, "e bigint, i int, p double, v double"), "e", "i", "p", "v", d, params=p, gap_ms=64, least_ms=64, pad_ms=32)
    got = t.groupBy("e").agg(F.sum(F.col("end_ms") - F.col("begin_ms")), F.min("begin_ms"), F.max("end_ms")).collect()
    assert {tuple(r) for r in got} == {(k, m * 32, 0, m * 32) for k, m in n.items()}


def test_voiced_tiles_of_recordings_without_signals(spark):
    """Recordings in which nothing is heard set off no signal and are one quiet tile, beside one that has speech."""
    levels = {1: [0.0] * 50, 2: [0.0] * 10 + [1.0] * 20 + [0.0] * 20, 3: [None] * 5, 4: [float("nan")]}
    rows = [(k, i, x, 0.9) for k, xs in levels.items() for i, x in enumerate(xs)]
    d = spark.createDataFrame([(k, len(xs) * 32) for k, xs in levels.items()], "e bigint, duration_ms bigint")
    p = audio.VoiceParams(confidence=0.5, min_volume=0.1, start_secs=0.064, stop_secs=0.064)
    t = regions.voiced_tiles(spark.createDataFrame(rows, "e bigint, i int, p double, v double"), "e", "i", "p", "v", d, params=p, gap_ms=64, least_ms=64, pad_ms=32)
    got = sorted(map(tuple, t.select("e", "label", "begin_ms", "end_ms").collect()), key=lambda r: (r[0], r[2]))
    assert [r for r in got if r[0] != 2] == [(1, "quiet", 0, 1600), (3, "quiet", 0, 160), (4, "quiet", 0, 32)]
    assert [r[1] for r in got if r[0] == 2] == ["quiet", "speaking", "quiet"]
