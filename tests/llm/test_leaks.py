import random
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
import regex

from tessitura.llm import leaks as L

WORDS = [f"từ{i}" for i in range(60)]
CJK = r"[\p{Han}\p{Hiragana}\p{Katakana}]"


def words(t):
    """The words one by one, as a plain reading of the definition."""
    t = regex.sub(r"(?m)^(?:\d+\s*\n)?[\d:.,]+ --> [\d:.,]+$", " ", t or "")
    t = regex.sub(r"<[^<>\n]*>", "", t)
    t = regex.sub(r"\p{M}+", "", unicodedata.normalize("NFKD", t)).casefold().replace("đ", "d")
    return regex.findall(rf"{CJK}|[\p{{L}}\p{{N}}--{CJK}]+", t, flags=regex.V1)


def text(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


def brute(items, docs):
    grams = {}
    for i, t in items:
        w = words(t)
        for k in range(len(w) - 11):
            grams.setdefault(tuple(w[k : k + 12]), set()).add(i)
    out = set()
    for d, t in docs:
        w = words(t)
        for k in range(len(w) - 11):
            out |= {(d, i) for i in grams.get(tuple(w[k : k + 12]), ())}
    return out


def found(items, docs):
    ix = L.Index(*L.hashed_words(pa.array([t for _, t in items], pa.string())))
    rows = L.leaks_of(ix, *L.hashed_words(pa.array([t for _, t in docs], pa.string())))
    return {(docs[d][0], items[i][0]): (n, s, r) for d, i, n, s, r in rows}


def test_equals_brute_force(spark):
    rng = random.Random(1)
    items = [(i, text(rng, 40)) for i in range(12)] + [(90, "quá ngắn"), (91, None)]
    docs = []
    for d in range(120):
        i, t = rng.choice(items[:12])
        w = t.split()
        a, n = rng.randint(0, 28), rng.choice([8, 11, 12, 20])
        part = " ".join(w[a : a + n])
        part = rng.choice([part, part.upper(), unicodedata.normalize("NFD", part), part.replace(" ", "</c><c> "), part.replace(" ", ",\n00:00:01.000 --> 00:00:02.000\n", 1)])
        docs.append((d, text(rng, 30) + " " + part + " " + text(rng, 30)))
    docs += [(500, None), (501, ""), (502, "x"), (3, docs[3][1])]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id bigint, text string, item_id int")
    it = spark.createDataFrame(items, "item_id bigint, text string")
    got = L.find_leaks(df, "doc_id", "text", it, "item_id", "text")
    want = brute(items, docs)
    rows = got.collect()
    assert want and {(r.doc_id, r.item_id) for r in rows if r.longest_run >= 12} == want
    assert sum((r.doc_id, r.item_id) == (3, rows[0].item_id) for r in rows) in (0, 2)  # a repeated row is reported again
    assert L.find_leaks(df.limit(0), "doc_id", "text", it, "item_id", "text").count() == 0
    assert L.find_leaks(df, "doc_id", "text", it.limit(0), "item_id", "text").count() == 0


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_WORDS", 40)
    rng = random.Random(2)
    items = [(i, text(rng, 14)) for i in range(8)] + [(8, text(rng, 100))]  # one is longer than a block
    df, it = spark.createDataFrame(items, "d bigint, t string"), spark.createDataFrame(items, "i bigint, t string")
    got = {(r.d, r.i) for r in L.find_leaks(df, "d", "t", it, "i", "t").collect()}
    assert {(i, i) for i in range(9)} <= got == brute(items, items)


def test_blocks_find_all_within_radius():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 300, dtype=np.uint64)
    b = a.copy()
    for k in range(len(b)):
        for bit in rng.choice(64, rng.integers(0, 6), replace=False):
            b[k] ^= np.uint64(1) << np.uint64(bit)
    x, y = L.Prints(b, np.arange(300)).near(a)
    want = {(i, j) for i in range(300) for j in range(300) if bin(int(a[i] ^ b[j])).count("1") <= L.RADIUS}
    assert len(x) == len(want) and set(zip(x.tolist(), y.tolist())) == want


@pytest.mark.parametrize("window", [12, 27])
def test_fingerprints_slide(window):
    h = L.hashes(" ".join(map(str, range(60))))
    p = L.fingerprints(h, window)
    assert len(p) == 61 - window and all(p[i] == L.fingerprints(h[i : i + window], window)[0] for i in range(len(p)))


@pytest.mark.parametrize("t", ["Đường VỀ nhà, ½ ﬁn Straße №5 ĐÈO", "東京タワーへ行く。今日も!", "สวัสดี ครับ नमस्ते", "a_b c-d 𝐀𝐁 x", "한국어 단어", "<i>một</i> hai\n00:00:01.000 --> 00:00:02.000\nba", "", "…", "éa"])
def test_words(t):
    h, w = L.hashes(t), words(t)
    assert len(h) == len(w) and len(set(h.tolist())) == len(set(w))
    assert (L.hashes(" ".join(w)) == h).all()


def test_unspaced_passages():
    """Twelve ideographs are twelve words, however few characters they are."""
    t = "春眠不覺曉處處聞啼鳥夜來"
    assert found([(1, t)], [(7, t), (8, "「" + t[:6] + "、" + t[6:] + "」"), (9, t[:11])]) == {(7, 1): (1, 1.0, 12), (8, 1): (1, 1.0, 12)}


def test_near_passages_are_all_found():
    """Recall against brute force over altered items: every stretch of similarity 0.8 or more, window by window."""
    rng = random.Random(5)
    items = [(i, " ".join(rng.choices([f"w{k}" for k in range(900)], k=rng.randint(13, 80)))) for i in range(60)]
    docs = []
    for d in range(600):
        i, t = rng.choice(items)
        w = t.split()
        for _ in range(rng.choice([0, 1, 1, 2])):
            k = rng.randrange(len(w))
            w[k : k + rng.randint(0, 1)] = rng.choice([[], ["khác"], ["thêm", w[k]]])
        docs.append((d, text(rng, 15) + " " + " ".join(w) + " " + text(rng, 15)))
    want = set()
    for d, t in docs:
        h = L.hashes(t)
        for i, x in items:
            g = L.hashes(x)
            if len(np.intersect1d(h, g)) > len(g) // 2 and max((L.shingle_similarity(h[k : k + len(g)], g) for k in range(max(1, len(h) - len(g) + 1))), default=0) >= L.SIMILAR:
                want.add((d, i))
    got = {k for k, (_, s, _) in found(items, docs).items() if s >= L.SIMILAR}
    altered = [k for k, (_, s, r) in found(items, docs).items() if L.SIMILAR <= s < 1]
    assert len(want) > 200 and len(altered) > 50 and len(got & want) >= 0.99 * len(want) and got <= want
