import pytest

from tessitura.llm import sentences as S


@pytest.mark.parametrize(
    "text,want",
    [
        ("Một câu. Hai câu! Ba?", ["Một câu.", "Hai câu!", "Ba?"]),
        ("TS. Lam Vy đến lúc 6.30 ở P. Bến Gỗ. Về rồi.", ["TS. Lam Vy đến lúc 6.30 ở P. Bến Gỗ.", "Về rồi."]),
        ("Mang dây, pin, v.v. Hết giờ.", ["Mang dây, pin, v.v.", "Hết giờ."]),
        ("Dây, pin, v.v. đều có.", ["Dây, pin, v.v. đều có."]),
        ("À... ừm... tôi quên.", ["À... ừm... tôi quên."]),
        ("“Dừng lại!” cô ấy nói. Hết.", ["“Dừng lại!” cô ấy nói.", "Hết."]),
        ("Anh hỏi: “Sao thế?” Chị cười.", ["Anh hỏi: “Sao thế?”", "Chị cười."]),
        ("Ca khúc (ghi ở đây. hơi ù) hay. Xong.", ["Ca khúc (ghi ở đây. hơi ù) hay.", "Xong."]),
        ("Kênh Hò Ơi! phát lại. Tệp a_1.wav ở x.example lỗi.", ["Kênh Hò Ơi! phát lại.", "Tệp a_1.wav ở x.example lỗi."]),
        ("Thiếu cách.Câu sau", ["Thiếu cách.", "Câu sau"]),
        ("không dấu\n\nDòng sau\ncùng câu", ["không dấu", "Dòng sau\ncùng câu"]),
        ("Mr. J. R. Tesk left at 9 p.m. The end, i.e. I slept.", ["Mr. J. R. Tesk left at 9 p.m.", "The end, i.e. I slept."]),
        ("“我们走吧！”他笑着说。老人说：“好。”下雨了。", ["“我们走吧！”他笑着说。", "老人说：“好。”", "下雨了。"]),
        ("「行こう！」と彼は言った。5.3秒だった。", ["「行こう！」と彼は言った。", "5.3秒だった。"]),
        ("डॉ. मणिक ने 5.6 मिनट सुना। कल आए।", ["डॉ. मणिक ने 5.6 मिनट सुना।", "कल आए।"]),
        ("เช้านี้ร้องเพลง เมื่อคืนใช้เวลา 36 นาที", ["เช้านี้ร้องเพลง", "เมื่อคืนใช้เวลา 36 นาที"]),
        ("♪ la la. ♪", ["♪ la la. ♪"]),
        ("", []),
        ("  ", []),
        (None, []),
    ],
)
def test_split(text, want):
    assert S.split(text) == want


def test_positions_rebuild_long_text():
    text = "Một câu ngắn. " * 5000
    ends = S.boundaries(text)
    assert len(ends) == 4999 and all(text[e - 1] == "." for e in ends)


def test_frames(spark):
    df = spark.createDataFrame([(1, "A b. C d.", 0), (1, "A b. C d.", 0), (2, None, 0), (3, "", 0), (4, "x", 0)], "unit_id bigint, text string, end_pos int")
    assert sorted(tuple(r) for r in S.sentence_ends(df, "unit_id", "text").collect()) == [(1, 4), (1, 4)]
    assert [tuple(r) for r in S.sentence_units(df, "unit_id", "text").orderBy("unit_id", "sentence_idx").collect()] == [(1, 0, "A b."), (1, 0, "A b."), (1, 1, "C d."), (1, 1, "C d."), (4, 0, "x")]
    assert S.sentence_ends(df.limit(0), "unit_id", "text").count() == 0


@pytest.mark.parametrize(
    "text,lang,want",
    [
        ("I said No. Then I left.", "en", 2),
        ("I said No. Then I left.", None, 2),
        ("See No. 5 here. Then go.", "EN-us", 2),
        ("Take Vol. 2 home. Read it.", "en", 2),
        ("Nhà ở Q. Bến Gỗ. Về rồi.", "vi", 2),
        ("Nhà ở Q. Bến Gỗ. Về rồi.", "en", 2),
        ("Hết bài.ThS. An Nhiễu hát.", "vi", 2),
    ],
)
def test_cascade_by_language(text, lang, want):
    assert len(S.split(text, lang)) == want


@pytest.mark.parametrize("n", [3, 600, 5000])
def test_brackets_of_any_length(n):
    inner = "Word here. " * n
    assert S.split(f"Sentence (One two. {inner}End) here. Next one.") == [f"Sentence (One two. {inner}End) here.", "Next one."]
    assert len(S.boundaries("(" + inner)) == n - 1  # never closed
