import pytest
from pyspark.sql import functions as F

from tessitura.functions import formats
from tessitura.operators import exports
from tessitura.sources import files


def test_bio(spark):
    t = spark.createDataFrame([(1, "Anh  Lam hát ở Bến Gỗ"), (2, "x")], "id int, text string")
    s = spark.createDataFrame([(1, 5, 8, "PER"), (1, 15, 21, "LOC")], "id int, start int, end int, label string")
    got = [r.tag for r in exports.bio_tokens(t, s, "id", "text").orderBy("id", "token_idx").collect()]
    assert got == ["O", "B-PER", "O", "O", "B-LOC", "I-LOC", "O"]


def test_boxes(spark):
    df = spark.createDataFrame([(10.0, 20.0, 30.0, 40.0, 0.0, 200, 100, 3), (50.0, 50.0, 10.0, 20.0, 90.0, 100, 100, 1)], "x double, y double, w double, h double, degrees double, width int, height int, k int")
    a, b = exports.pixel_boxes(df).orderBy("x").collect()
    assert tuple(a.box) == pytest.approx((20, 20, 60, 40)) and a.area == pytest.approx(2400)
    assert tuple(b.box) == pytest.approx((30, 50, 20, 10))
    assert exports.centre_lines(df, "k").orderBy("x").first().line == "3 0.250000 0.400000 0.300000 0.400000"
    assert exports.corner_boxes(df).orderBy("x").first()[-4:] == (20, 20, 80, 60)


def test_tasks(spark, tmp_path):
    (tmp_path / "t.json").write_text(
        '[{"id": 1, "annotations": [{"created_at": "1", "was_cancelled": false, "result": [{"from_name": "a", "value": "old"}]},'
        '{"created_at": "2", "was_cancelled": false, "result": [{"from_name": "a", "value": "x"}, {"from_name": "b", "value": "y"}]},'
        '{"created_at": "3", "was_cancelled": true, "result": [{"from_name": "a", "value": "no"}]}]}, {"id": 2, "annotations": []}]'
    )
    got = {r.id: r.labels for r in exports.flat_records(files.annotations(files.tasks(spark, str(tmp_path)))).collect()}
    assert got == {1: {"a": ["x"], "b": ["y"]}, 2: {}}


def test_lists_and_missing(spark, tmp_path):
    (tmp_path / "l.txt").write_text("keyword\n# note\nVọng cổ\n\nvọng CỔ\nhát ru\n")
    assert [r.value for r in files.text_list(spark, str(tmp_path / "l.txt"), ("keyword",)).orderBy("line_no").collect()] == ["Vọng cổ", "hát ru"]
    assert files.rows_or_empty(spark, str(tmp_path / "none"), "a int").count() == 0
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    files.write_table(df, str(tmp_path / "o"))
    files.write_table(df.filter("false"), str(tmp_path / "o"), overwrite=False)
    assert files.rows_or_empty(spark, str(tmp_path / "o"), "i int, s string").count() == 1


def test_caption_and_wav_files(spark, tmp_path):
    from tessitura.operators import audio

    (tmp_path / "v1__a.vtt").write_text("x")
    (tmp_path / "v1__b.vi.vtt").write_text("chào", encoding="utf-8-sig")
    (tmp_path / "a.wav").write_bytes(audio.encode_wav([1, 2, 3], 16000))
    assert [tuple(r) for r in files.caption_files(spark, str(tmp_path)).select("video_id", "text").collect()] == [("v1", "chào")]
    assert files.wav_files(spark, str(tmp_path)).first().wav.samples == [1, 2, 3]
    assert files.audio_files(spark, str(tmp_path)).count() == 1


def test_formats(spark):
    df = spark.createDataFrame([("Xin  Chào bạn", "xin", "log\nNoise floor dB: -55.5\nNoise floor dB: -inf", "a/b c.wav")], "t string, p string, l string, f string")
    r = df.select(
        formats.without_prefix(F.col("t"), F.col("p")).alias("a"), formats.noise_floor(F.col("l")).alias("b"), formats.stable_name(F.col("f")).alias("c"),
        formats.match_score(F.lit("hát ru miền tây"), F.array(F.lit("hát ru"), F.lit("tây"), F.lit("bắc"))).alias("d"),
        formats.retry_delay(F.lit(2), F.lit(True)).alias("e"), formats.progress(F.lit("crawl_audio"), F.lit("running"), F.lit(1), F.lit(4)).alias("g"),
    ).first()
    assert r.a == "Chào bạn" and r.b == float("-inf") and r.c.startswith("a__b_c__") and r.d == 3 and r.e == 450.0 and r.g == 33
