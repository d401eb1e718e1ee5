import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessitura.llm import mixing, splits

COLS = "video_id string, audio_id string, segment_id string, source_url string, quality_label string, split_name int"


def rows(seed=1, n=400):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        v = rng.randint(0, 60)
        url = rng.choice([None, "", "https://x/watch?v=", f"https://x/watch?a=1&v=K{rng.randint(0, 90)}&t=1"])
        out.append((rng.choice([f"v{v}", f"V{v}", "", None]), rng.choice([f"a{v}", None, " "]), rng.choice([f"s{i}", f"s{v}", None]), url, rng.choice(["x", "y", None]), 3))
    return out + out[:20]


def union_find(data):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for v, a, s, u, *_ in data:
        key = u.split("v=")[1].split("&")[0] if u and "v=" in u else ""
        ks = [k + ":" + x for k, x in (("v", v), ("a", a), ("s", s), ("k", key)) if x and x.strip()]
        for k in ks[1:]:
            parent[root(k)] = root(ks[0])
        if ks:
            root(ks[0])
    vids = sorted(x for x in parent if x.startswith("v:"))
    return {(a[2:], b[2:]) for a in vids for b in vids if a < b and root(a) == root(b)}, root


def test_pairs_equal_union_find(spark):
    data = rows()
    got = {tuple(r) for r in splits.tied_pairs(spark.createDataFrame(data, COLS), splits.recording_keys()).collect()}
    want, _ = union_find(data)
    assert want and got == want
    assert splits.tied_pairs(spark.createDataFrame([], COLS), splits.recording_keys()).count() == 0


def test_splits_keep_together(spark):
    data = [(f"v{i}" if i > 300 else f"v{i // 3}", None, f"s{i}", None, random.Random(i).choice("xyz"), 1) for i in range(900)] + [(None, None, None, None, None, 1)] * 30
    df = spark.createDataFrame(data, COLS).drop("split_name")
    out = splits.assign_splits(df, splits.recording_keys(), F.col("quality_label"), [("train", 0.8), ("valid", 0.1), ("test", 0.1)])
    got = out.collect()
    assert len(got) == len(data) and out.columns == [*df.columns, "split_name"]
    of = {}
    for r in got:
        if r.video_id:
            assert of.setdefault(r.video_id, r.split_name) == r.split_name
    for lab in "xyz":
        n = [r.split_name for r in got if r.quality_label == lab]
        assert abs(n.count("train") / len(n) - 0.8) < 0.03


def test_place_prefers_rarest():
    v = np.array([[5, 0, 5], [0, 1, 1], [0, 1, 1], [5, 0, 5]], float)
    out = splits.place(v, np.array([0.5, 0.5])[:, None] * v.sum(axis=0)[None, :])
    assert {out[1], out[2]} == {0, 1} and {out[0], out[3]} == {0, 1}


@pytest.mark.parametrize("mean,cap", [(0.3, 1), (0.999, 1), (2.5, 3), (0.01, 6), (4.0, 6), (700.0, 2000)])
def test_rate(mean, cap):
    assert mixing.capped_mean(mixing.rate_for(mean, cap), cap) == pytest.approx(mean, rel=1e-6)


def test_mixture(spark):
    rng = random.Random(4)
    docs = [(i, rng.choice(["a", "a", "a", "b", "c"]), "xin chào các bạn " * rng.randint(1, 5), 7) for i in range(3000)]
    docs += [(9001, None, "x", 7), (9002, "a", None, 7), (9003, "b", "", 7)]
    df = spark.createDataFrame(docs, "doc_id bigint, source string, text string, copy2 int")
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.4, 2), ("gone", 0.1, 3)], "source string, target_share double, max_repeats int")
    s = {r.source: r for r in mixing.shares(df, t).collect()}
    assert s["a"].actual_share == pytest.approx(0.5 / 0.9, abs=0.002) and s["gone"].tokens == 0 and s["gone"].shortfall_tokens > 0
    assert s["b"].most_repeats <= 2 and s["a"].most_repeats == 1
    m = mixing.mix(df, t)
    got = m.groupBy("source").agg(F.count("*").alias("n")).collect()
    assert {r.source: r.n for r in got} == {k: r.copies for k, r in s.items() if r.copies}
    keys = [r.mix_key for r in m.select("mix_key").collect()]
    assert keys == sorted(keys) and m.groupBy("doc_id", "copy").count().filter("count > 1").count() == 0
    assert mixing.mix(df.limit(0), t).count() == 0 and {r.tokens for r in mixing.shares(df.limit(0), t).collect()} == {0}
    few = spark.createDataFrame([("a", 0.999, 1), ("c", 0.001, 1)], "source string, target_share double, max_repeats int")
    assert sum(r.tokens for r in mixing.shares(df, few, total=20_000.0).collect()) == pytest.approx(20_000, rel=0.01)
    short = {r.source: r for r in mixing.shares(df, t, total=1e6).collect()}
    assert all(r.shortfall_tokens == r.wanted_tokens - r.tokens > 0 for r in short.values())
    assert short["b"].tokens == 2 * short["b"].available_tokens
    with pytest.raises(ValueError):
        mixing.shares(df, spark.createDataFrame([("a", 1.0, 2_000_000)], "source string, target_share double, max_repeats int"))


def test_place_many_equals_one_by_one():
    rng = np.random.default_rng(5)
    v = rng.integers(0, 3, (6, 3))
    v = np.unique(np.column_stack([v, v.sum(axis=1)]), axis=0)
    times = rng.integers(1, 40, len(v))
    want = np.array([0.8, 0.1, 0.1])[:, None] * (v * times[:, None]).sum(axis=0)[None, :]
    got = splits.place_many(v, times, want)
    each = np.repeat(np.arange(len(v)), times)
    one = splits.place(v[each], want)
    assert (got.sum(axis=1) == times).all()
    assert np.abs((got.T @ v) - np.array([v[each][one == s].sum(axis=0) for s in range(3)])).max() <= v.max()


def test_many_labels_and_coarse_classes(spark, monkeypatch):
    """No label is merged with others; with few classes allowed, rows and labels still come near their shares."""
    rng = random.Random(8)
    data = [(f"v{i // 4}", None, None, None, f"label {rng.randint(0, 59)}", 1) for i in range(12_000)]
    df = spark.createDataFrame(data, COLS)
    for most, near in ((50_000, 2), (200, 20)):
        monkeypatch.setattr(splits, "MAX_CLASSES", most)
        out = splits.assign_splits(df, splits.recording_keys(), F.col("quality_label"), [("train", 0.8), ("valid", 0.1), ("test", 0.1)])
        got = {(r.quality_label, r.split_name): r["count"] for r in out.groupBy("quality_label", "split_name").count().collect()}
        n = {s: sum(v for (_, t), v in got.items() if t == s) for s in ("train", "valid", "test")}
        assert sum(n.values()) == len(data) and abs(n["train"] - 9600) <= 10 and abs(n["test"] - 1200) <= 10
        each = {k: sum(v for (x, _), v in got.items() if x == k) for k, _ in got}
        assert max(abs(got.get((k, "test"), 0) - 0.1 * each[k]) for k in each) <= near
    monkeypatch.setattr(splits, "MAX_LABELS", 59)
    with pytest.raises(ValueError):
        splits.assign_splits(df, splits.recording_keys(), F.col("quality_label"), [("train", 1.0)])


def test_rows_follow_the_shares_though_all_components_hold_all_labels():
    rng = np.random.default_rng(6)
    size = np.maximum(rng.pareto(1.2, 500) * 10, 1).astype(int)
    v = np.stack([rng.multinomial(s, [0.6, 0.2, 0.1, 0.1]) for s in size])
    v = np.column_stack([v, v.sum(axis=1)]).astype(float)
    share = np.array([0.8, 0.1, 0.1])
    got = splits.place(v, share[:, None] * v.sum(axis=0)[None, :])
    rows = np.array([v[got == s, -1].sum() for s in range(3)]) / v[:, -1].sum()
    assert np.abs(rows - share).max() < 0.001


def test_groups(spark):
    data = rows(3)
    got = {r.id: r.group_id for r in splits.groups(spark.createDataFrame(data, COLS), splits.recording_keys()).collect()}
    _, root = union_find(data)
    vids = {r[0] for r in data if r[0] and r[0].strip()}
    assert got == {v: min(w for w in vids if root("v:" + w) == root("v:" + v)) for v in vids}


def test_rare_label_keeps_its_shares_among_many_components(spark):
    n = 60_000
    label = F.when(F.col("id") % 2000 == 0, "rare").when(F.col("id") % 2 == 0, "x").otherwise("y")
    df = spark.range(n).select(F.concat(F.lit("v"), "id").alias("video_id"), *[F.lit(None).cast("string").alias(c) for c in ("audio_id", "segment_id", "source_url")], label.alias("quality_label"))
    out = splits.assign_splits(df, splits.recording_keys(), F.col("quality_label"), [("train", 0.8), ("valid", 0.1), ("test", 0.1)])
    got = {(r.quality_label, r.split_name): r["count"] for r in out.groupBy("quality_label", "split_name").count().collect()}
    assert [got.get(("rare", s), 0) for s in ("train", "valid", "test")] == [24, 3, 3]
    assert all(abs(got["y", s] - 30_000 * t) <= 1 for s, t in (("train", 0.8), ("valid", 0.1), ("test", 0.1)))
    assert splits.assign_splits(df.limit(0), splits.recording_keys(), F.col("quality_label"), [("train", 1.0)]).count() == 0


def test_many_label_vectors_do_not_change_the_method(spark, monkeypatch):
    """The splits are the same whatever MAX_CLASSES is: beyond it no vector is replaced by a mean."""
    rng = random.Random(9)
    df = spark.createDataFrame([(f"v{i // 4}", None, None, None, f"label {rng.randint(0, 19)}", 1) for i in range(2_000)], COLS)
    targets = [("train", 0.8), ("valid", 0.1), ("test", 0.1)]
    got = []
    for most in (50_000, 100):
        monkeypatch.setattr(splits, "MAX_CLASSES", most)
        got.append({(r.video_id, r.split_name) for r in splits.assign_splits(df, splits.recording_keys(), F.col("quality_label"), targets).collect()})
    assert got[0] == got[1] and len(got[0]) == 500
