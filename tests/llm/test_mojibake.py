import pytest

from tessitura.llm import mojibake as M

CLEAN = ["xin cảm ơn người nghe đài đã gửi thư", "chú lái đò hát bài hát ru giữa cánh đồng", "Mất bao lâu? – cô ca sĩ hỏi."] * 40 + [
    "the café in Åsvik is naïve", "vé vào cửa £5", "quán bán crème brûlée 5 €", "Señora gửi thư", "ĐÃ… RỒI", "chờ\xa0đã", "gì?Không"
]
TEXT = "cô ca sĩ đã hát giữa cánh đồng"


@pytest.fixture(scope="module")
def counts():
    return M.count_grams([t for t in CLEAN if not M._suspicious.search(t)])


@pytest.mark.parametrize("codec", ["latin-1", "cp1258", "mac_roman", "cp437", "cp850", "cp1251"])
def test_restores(counts, codec):
    bad, fixed = M.repairer(counts)([TEXT.encode().decode(codec, "replace"), None, ""])
    assert bad == [True, False, False]
    assert fixed[0] in (TEXT, None)


def test_twice_partly_tones_and_lost(counts):
    many = M.repairer(counts)
    one = TEXT.encode().decode("latin-1")
    twice = one.encode().decode("latin-1")
    part = "cô ca sĩ " + "đã hát".encode().decode("latin-1") + " giữa cánh đồng"
    tones = "caÒm õn ngýõÌi"
    assert many([one, twice, part])[1] == [TEXT, TEXT, TEXT]
    assert many([tones])[1] == ["cảm ơn người"]
    assert many(["c? ca s? ?? h?t gi?a c?nh ??ng", "hát � rồi"]) == ([True, True], [None, None])


def test_clean_stays(counts):
    assert not any(M.repairer(counts)(CLEAN)[0])


def test_frame(spark):
    rows = [(i, t, "x") for i, t in enumerate(CLEAN)] + [(1000, TEXT.encode().decode("latin-1"), "y"), (1001, None, None), (1002, "", None), (1003, TEXT.encode().decode("latin-1"), "z")]
    df = spark.createDataFrame(rows, "cue_id bigint, text string, restored string")
    got = sorted(tuple(r) for r in M.find_garbled(df, "cue_id", "text").select("cue_id", "restored").collect())
    assert got == [(1000, TEXT), (1003, TEXT)]
    assert M.find_garbled(df.limit(0), "cue_id", "text").count() == 0


def test_validation(counts):
    r = M.validate(CLEAN, counts)
    assert r["false"] == 0 and r["found"] > 0.95 and r["restored"] > 0.85


def test_no_image_is_passed_over():
    """Every letter's image under every encoding is suspicious, in one word or alone, by pattern and by column."""
    import pyarrow as pa

    from tessitura.llm import codepoints as cp

    texts = [f(x) for codec in M.SINGLE for c in M.VIET for x in [M.image(c, codec)] for f in (str, lambda x: f"nh{x} ai")]
    assert all(map(M._suspicious.search, texts)) and M.suspicious(*cp.points(pa.array(texts))).all()
    assert not M.suspicious(*cp.points(pa.array(["Ăn cơm", "bãi biển", "ã í", "Ă ’"]))).any()


def test_margin_is_validated(counts):
    held = [f"{a} {b} giữa cánh đồng" for a in ("chú lái đò", "cô ca sĩ", "người nghe đài") for b in ("hát", "gửi thư", "cảm ơn", "hỏi", "ru", "đã gửi", "nghe đài")]
    assert 0.5 < M.fit_margin(counts, held) < 5 and M.fit_margin(counts, held[:3]) == M.MARGIN


def test_other_scripts_are_trained(spark):
    rows = [(t,) for t in ("สวัสดีครับ ร้องเพลง", "今日は元気です", "मैंने गीत सुना", "привет всем") for _ in range(3)]
    counts = M.train(spark.createDataFrame(rows, "text string"), "text")
    model = M.Model(counts)
    a, b = model.logp(["สวัสดี", "ดีสัสวส"])
    assert a > b and not any(M.repairer(counts)([r[0] for r in rows])[0])


def test_utf16_and_more_code_pages(counts):
    many = M.repairer(counts)
    for codec in ("cp1253", "cp1254", "cp1256", "cp1257"):
        bad = "".join(M.image(c, codec) if c > "\x7f" else c for c in TEXT)
        assert many([bad])[0] == [True]
    assert many([TEXT.replace("đ", "d").encode("utf-8")[:-(len(TEXT.replace("đ", "d").encode()) % 2) or None].decode("utf-16-le", "replace")])[0] == [True]


def test_gains_equal_scoring_whole_texts(counts):
    """Word by word, in batches that share words, as by the model on the changed words of each text."""
    texts = [t for t in CLEAN[:3] + CLEAN[-7:] if not t.isascii()] + ["a  ô", "é", "ÔNG ấy đi"]
    model = M.Model(counts)
    of = M.Gains(model)
    got = [of.of(texts[:4]), of.of(texts[4:])]
    for t, g in zip(texts, [*got[0].T, *got[1].T]):
        for codec, one in zip(M.SINGLE, g):
            bad = "".join(M.image(c, codec) if c > "\x7f" else c for c in t)
            x, y = M.changed(bad, t)
            a, b = model.logp([x, y])
            assert one == pytest.approx(b / (len(y) + 1) - a / (len(x) + 1))


def test_all_records_are_trained_and_validate(spark):
    """No record is left out of the counts, and each that isn't suspicious is counted in the margin, with every encoding."""
    texts = [f"chú lái đò {i} hát" for i in range(3_000)] + ["plain", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    assert (M.train(df, "text") == M.count_grams([t for t in texts if t is not None])).all()
    folds = M.train_folds(df, "text")
    assert M.gained(df, "text", folds).sum() == 3_000 * len(M.SINGLE)
    got, margin = M.fit(df, "text")
    assert (got == folds.sum(axis=0)).all() and margin == M.fit(df.repartition(1), "text")[1] != M.MARGIN


def test_sentences_ask_a_model_of_all_records(spark, tmp_path, monkeypatch):
    """p2_found: no record of the cues is left out of the counts that its model is made of."""
    from tessitura.llm import queries

    texts = [f"chú lái đò {i} hát. Cô ca sĩ nghe." for i in range(300)]
    spark.createDataFrame(list(enumerate(texts)), "cue_id bigint, text string").write.parquet(str(tmp_path / "transcript_cues.parquet"))
    spark.createDataFrame([(1, "Xin chào. Tôi đây.", "vi")], "unit_id bigint, text string, lang string").write.parquet(str(tmp_path / "sentence_units.parquet"))
    seen = []
    whole = M.fit
    monkeypatch.setattr(M, "fit", lambda *x: seen.append(whole(*x)) or seen[-1])
    got = queries.p2_found(spark, str(tmp_path)).collect()
    assert len(got) == 301 and (seen[0][0] == M.count_grams(texts)).all()


def test_clean_records_with_other_letters_validate(spark, tmp_path, monkeypatch):
    """Clean records with letters that a chain might have made are counted in the margin too, and p2_found asks that margin."""
    from tessitura.llm import queries

    texts = [f"chú lái đò {i} hát. Cô nghe." for i in range(60)] + [f"Señora {i} gửi thư. Cô nghe." for i in range(50)] + [f"привет всем {i}. Да." for i in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "cue_id bigint, text string").repartition(3)
    gained = M.gained(df, "text", M.train_folds(df, "text"))
    assert gained.sum() == len(texts) * len(M.SINGLE)
    df.write.parquet(str(tmp_path / "transcript_cues.parquet"))
    spark.createDataFrame([], "unit_id bigint, text string, lang string").write.parquet(str(tmp_path / "sentence_units.parquet"))
    seen = []
    whole = M.fit
    monkeypatch.setattr(M, "fit", lambda *x: seen.append(whole(*x)) or seen[-1])
    assert queries.p2_found(spark, str(tmp_path)).count() == len(texts) and seen[0][1] == M.margin_of(gained)
