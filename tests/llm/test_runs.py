import random

from pyspark.sql import functions as F

from tessitura.llm import runs


def osa(a, b):
    d = [[max(i, j) if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_slip(spark):
    random.seed(1)
    pairs = [("", "a"), ("ab", "ba"), ("abc", "acb"), ("x1", "x2"), ("x12", "x1"), ("đừng", "đừgn"), ("a", "a"), (None, "a"), (None, None)]
    pairs += [("".join(random.choices("abc", k=random.randint(1, 5))), "".join(random.choices("abc", k=random.randint(1, 5)))) for _ in range(300)]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", runs.same_but_slip(F.col("a"), F.col("b")).alias("s"))
    for a, b, s in df.collect():
        number = lambda t: "".join(c for c in t if c.isdigit())
        want = a is not None and b is not None and osa(a, b) <= 1 and (number(a) == number(b))
        assert s == want, (a, b)


def test_key(spark):
    texts = ["<i>Xin  Chào!</i>", "x<00:01.000><c>in</c> chào", "♪ … ♪", "", None, "take 1 2", "take 12", "[Music]"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(runs.spoken_key(F.col("t"))).collect()]
    assert got[:2] == ["xinchào", "xinchào"] and got[2:5] == [None, None, None]
    assert got[5] != got[6] and got[7] == "music"


def test_collapse_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(runs, "BLOCK", 4)
    random.seed(2)
    words = ["la la", "La la!", "la laa", "ho", None, " ", "ho hey", "7 x", "8 x"]
    rows, want = [], []
    for ent in ("a", "b", "c"):
        pos, seq = 0, []
        for _ in range(200):
            pos += random.choice([1, 1, 1, 3, 9])
            seq.append((pos, random.choice(words[:3] if random.random() < 0.6 else words)))
        for p, t in seq:
            rows += [(ent, p, t, p * 1.0, p + 0.5, 1, p, "x", 9)] * random.choice([1, 1, 2])
        rows.append((ent, seq[0][0], "other", 0.0, 0.0, 0, 0, "x", 9))  # an earlier load, overridden
        key = lambda t: "".join(c for c in t.lower() if c.isalnum()) if t and t.strip() else None
        run = []
        for p, t in [*seq, (None, None)]:
            k = key(t) if t else None
            if run and k and osa(run[-1][1], k) <= 1 and "".join(filter(str.isdigit, run[-1][1])) == "".join(filter(str.isdigit, k)):
                run.append((p, k))
                continue
            if run:
                want.append((ent, run[0][0], run[-1][0], len(run)))
            run = [(p, k)] if k else []
    rows += [(None, 1, "x", 0.0, 1.0, 1, 1, "x", 9), ("a", None, "x", 0.0, 1.0, 1, 1, "x", 9)]
    df = spark.createDataFrame(rows, "audio_id string, cue_idx int, text string, s double, e double, loaded int, id int, key string, rn int")
    out = runs.collapse_runs(df, "audio_id", "cue_idx", "text", "s", "e", ["loaded", "id"])
    got = sorted(tuple(r)[:4] for r in out.collect())
    assert got == sorted(want)
    two = runs.collapse_runs(df, "audio_id", "cue_idx", "text", "s", "e", ["loaded", "id"], 2)
    assert sorted(tuple(r)[:4] for r in two.collect()) == sorted(w for w in want if w[3] > 1)
    assert out.filter("duration < 0").count() == 0
    assert runs.collapse_runs(df.limit(0), "audio_id", "cue_idx", "text", "s", "e", ["loaded", "id"]).count() == 0


def test_sparse_positions_and_decomposed_accents(spark):
    import unicodedata

    rows = [("a", 1_700_000_000_000 + 3000 * i, unicodedata.normalize("NFD" if i % 2 else "NFC", f"đừng về {i // 5}x"), 1.0 * i, i + 1.0, 1) for i in range(9000)]
    rows += [("b", 10**15, "x", 0.0, 1.0, 1), ("b", 5, "x", 0.0, 1.0, 1)]
    df = spark.createDataFrame(rows, "ent string, pos bigint, text string, s double, e double, n int")
    out = runs.collapse_runs(df, "ent", "pos", "text", "s", "e", ["n"], 2)
    got = out.collect()
    assert sum(r.n_events for r in got if r.ent == "a") == 9000 and len([r for r in got if r.ent == "a"]) == 1800 and len([r for r in got if r.ent == "b"]) == 1
