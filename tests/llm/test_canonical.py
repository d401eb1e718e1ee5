import pytest

from tessitura.llm import canonical as C


@pytest.mark.parametrize(
    "text,differs",
    [
        ("bình thường", False),
        ("é", True),
        ("ｗａｓ", True),
        ("ﬁve", True),
        ("a​b", True),
        ("﻿xin", True),
        ("xin chào", True),
        ("hi‑fi", True),
        ("MС", True),  # Cyrillic С
        ("Ðừng", True),
        ("привет всем", False),
        ("Ελα να", False),
        ("او آرام می‌خواند", False),
        ("👩‍🎤 👏🏽 ❤️", False),
        ("今日は、よろしく！", False),
        ("12 m² ½ 25 °C ™ “x”", False),
        ("गीत", False),
        ("ทำ", False),
        ("", False),
        (None, False),
        ("plain", False),
        ("một\u3000hai", True),
        ("今日は\u3000元気", False),
        ("का\u093c", False),
        ("آب", False),
        ("ا\u0653ب", True),  # decomposed alef with madda
        ("क़लम", False),
    ],
)
def test_differs(text, differs):
    assert C.differs(text) is differs


def test_one_form():
    assert C.canonical("Ｘｉｎ  cha\u0300o\u200b M\u0421 \ufb01") == C.canonical("xin chào mc fi")
    assert C.canonical(None) is None and C.canonical("") == "" and C.canonical("Straße") == "strasse"
    for t in ("Ｘｉｎ", "é", "MС", "می‌خواند"):
        assert not C.differs(C.canonical(t))


def test_confusables(spark):
    looks = C.confusables(spark)
    assert len(looks) > 200 and all(looks[a] == b for a, b in {"ꓮ": "A", "Ꭱ": "R", "С": "C", "ο": "o", "ս": "u"}.items()) and set(C.LOOKS) <= set(looks)
    assert C.ordinary("ꓮnna vꓳ Ꭱob", looks) == "Anna vO Rob" and not C.differs("ꓮꓳ ꓐꓯ", looks) and not C.differs("привет сор", looks)


def test_only_flagged_texts_change(spark):
    """may_change() lets no text pass that ordinary() would change."""
    import pyarrow as pa

    looks = C.confusables(spark)
    texts = [f"a{chr(i)}b {chr(i)} x" for i in range(0x80, 0x3400) if not 0xD800 <= i < 0xE000] + ["\U0001d400x", "a\U000e0001"]
    open_ = C.may_change(pa.array(texts), looks)
    assert all(o or not C.differs(t, looks) for t, o in zip(texts, open_)) and not open_.all()


def test_frames(spark):
    df = spark.createDataFrame([(1, "ｗ", None, 5), (1, "ｗ", "x", 5), (2, "", "a­b", 5)], "ws_id bigint, hypothesis string, reference string, field int")
    got = sorted(tuple(r) for r in C.different_forms(df, "ws_id", ["hypothesis", "reference"]).collect())
    assert got == [(1, "hypothesis"), (1, "hypothesis"), (2, "reference")]
    assert [r.hypothesis_canonical for r in C.canonical_columns(df, ["hypothesis"]).collect()] == ["w", "w", ""]
    assert C.different_forms(df.limit(0), "ws_id", ["hypothesis"]).count() == 0
