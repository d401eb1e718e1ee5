import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessitura.operators.dyadic import CELL, interval_gaps, merge_intervals, to_ms, union_in_cells
from pyspark.sql import functions as F

SPAN = 1 << CELL


def brute(rows):
    out = []
    for s, e in sorted((s, e) for s, e in rows if s is not None and e is not None and e > s):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 63), st.integers(1, 30)), min_size=1, max_size=15))
def test_union_equals_brute_force(pairs):
    rows = [(s, min(s + n, 64)) for s, n in pairs]
    s, e = np.array(rows).T
    _, begin, end = union_in_cells(np.zeros(len(rows), int), s, e)
    assert list(zip(begin, end)) == brute(rows)


def test_cells_stay_apart():
    at, begin, end = union_in_cells(np.array([0, 1]), np.array([SPAN - 2, 0]), np.array([SPAN, 3]))
    assert list(zip(at, begin, end)) == [(0, SPAN - 2, SPAN), (1, 0, 3)]


def test_periods_and_gaps(spark):
    rng = np.random.default_rng(1)
    data, want_p, want_g = [], set(), set()
    for name in ("a", "b", "c"):
        s = rng.integers(-3 * SPAN, 5 * SPAN, 40)
        rows = [(int(x), int(x + n)) for x, n in zip(s, rng.integers(0, SPAN // 2 if name != "c" else 4 * SPAN, 40))]
        rows += rows[:5] + [(None, 5), (7, None), (9, 9), (20, 10)]
        data += [(name, s, e, "x", 1) for s, e in rows]
        p = brute(rows)
        want_p |= {(name, *x) for x in p}
        want_g |= {(name, a[1], b[0]) for a, b in zip(p, p[1:])}
    data.append((None, 1, 5, "x", 1))
    # extra columns with the names that the operator uses inside must not disturb it
    df = spark.createDataFrame(data, "k string, s bigint, e bigint, cell string, last_in_cell int")
    got = {tuple(r) for r in merge_intervals(df, ["k"], "s", "e").collect()}
    assert got == want_p
    assert {tuple(r) for r in interval_gaps(df, ["k"], "s", "e").collect()} == want_g
    short = {x for x in want_g if x[2] - x[1] < 200_000}
    assert {tuple(r) for r in interval_gaps(df, ["k"], "s", "e", 200_000).collect()} == short
    assert merge_intervals(df.limit(0), ["k"], "s", "e").count() == 0
    assert interval_gaps(df.limit(0), ["k"], "s", "e").count() == 0


def test_to_ms(spark):
    df = spark.createDataFrame([(1.0004,), (2.0006,), (float("nan"),), (None,), (1e300,)], "x double")
    assert [r[0] for r in df.select(to_ms(F.col("x"))).collect()] == [1000, 2001, None, None, None]


def test_long_intervals_are_few_rows(spark):
    """Ends written as other units: intervals of centuries among short ones, with entity columns named as inner ones."""
    import random

    from tessitura.operators import dyadic

    rng = random.Random(7)
    rows = []
    for ent in ("a", "b", "c"):
        for _ in range(60):
            s = rng.randint(-(1 << 34), 1 << 34)
            n = rng.choice([rng.randint(1, 5000), rng.randint(1, SPAN * 3), rng.randint(SPAN * 60, SPAN * 5000) if ent != "c" else 7])
            rows.append((ent, s, s + n))
    rows += [("b", 0, 1_700_000_000_000), ("d", -(1 << 62), (1 << 62) + 5), ("d", 5, 9), ("e", 1 << 61, (1 << 61) + 3), (None, 0, 5)]
    df = spark.createDataFrame(rows, "s string, cell long, e long")
    got = {}
    for r in merge_intervals(df, ["s"], "cell", "e").collect():
        got.setdefault(r.s, []).append((r.begin_ms, r.end_ms))
    want = {k: brute([(a, b) for x, a, b in rows if x == k]) for k in "abcde"}
    assert {k: sorted(v) for k, v in got.items()} == want
    gaps = sorted((r.s, r.gap_start_ms, r.gap_end_ms) for r in interval_gaps(df, ["s"], "cell", "e").collect())
    assert gaps == sorted((k, x[1], y[0]) for k, v in want.items() for x, y in zip(v, v[1:]))
    one = spark.createDataFrame([("d", -(1 << 62), (1 << 62) + 5)], "s string, a long, b long")
    assert dyadic._cell_periods(one, ["s"], "a", "b").count() < 100
