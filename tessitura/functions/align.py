"""Word and character alignment: operations, and counts of substitutions, deletions, insertions and matches.

Costs go row by row, a row at once: what a cell takes from its left neighbour is a running minimum. Ties go to the
diagonal, then to a deletion, then to an insertion. Equal ends are matched first, and of the rest only the diagonals that
a best alignment can reach are computed, so that time grows with the length times the errors. Only every so many rows are
kept; the way back computes those between anew, so that memory grows with the width times the root of the height.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

COUNTS = "struct<sub:int,del:int,ins:int,cor:int,n_ref:int,n_hyp:int>"
OPS = "array<struct<op:string,ref:string,hyp:string,ref_at:int,hyp_at:int>>"
EQUAL, SUB, DEL, INS = range(4)
#: Names of the operations.
NAMES = ("EQUAL", "SUB", "DEL", "INS")


def _codes(ref: list[str], hyp: list[str]) -> tuple[np.ndarray, np.ndarray]:
    number: dict[str, int] = {}
    return tuple(np.array([number.setdefault(w, len(number)) for w in ws], np.int64) for ws in (ref, hyp))


def _band(a: np.ndarray, b: np.ndarray, low: int, width: int, every: int) -> tuple[dict[int, np.ndarray], int]:
    """(every so many rows of costs, the cost of the whole), on ``width`` diagonals from ``low`` on; at [i][k] is the cost
    of the first i of a and the first i + low + k of b. Costs off the band count as too high ones."""
    row = np.arange(low, low + width)
    row = np.where(row < 0, len(a) + len(b) + 1, row)
    kept = {0: row}
    for i in range(1, len(a) + 1):
        row = _row(row, a[i - 1], b, i + low)
        if i % every == 0:
            kept[i] = row
    return kept, int(row[len(b) - len(a) - low])


def _row(before: np.ndarray, r: int, b: np.ndarray, first: int) -> np.ndarray:
    """The next row of costs, whose first cell is column ``first``."""
    width = len(before)
    same = np.zeros(width, bool)
    lo, hi = max(first, 1), min(first + width, len(b) + 1)
    if hi > lo:
        same[lo - first : hi - first] = b[lo - 1 : hi - 1] == r
    best = before + ~same
    best[:-1] = np.minimum(best[:-1], before[1:] + 1)
    steps = np.arange(width)
    return np.minimum.accumulate(best - steps) + steps


def path(ref: list[str], hyp: list[str]) -> np.ndarray:
    """The operations of the best alignment, in order."""
    a, b = _codes(ref, hyp)
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - short :] != b[len(b) - short :])
    tail = short - 1 - int(differ[-1]) if len(differ) else short  # equal ends: the way back goes along the diagonal
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    n, m = len(a), len(b)
    every, most = max(1, int(n**0.5)), abs(m - n) + 16
    while True:  # a best alignment of at most ``most`` errors keeps to these diagonals, as do all that are as good
        aside = (most - abs(m - n)) // 2
        low = min(0, m - n) - aside
        width = abs(m - n) + 2 * aside + 1
        kept, cost = _band(a, b, low, width, every)
        if cost <= most:
            break
        most = min(2 * most, cost)
    out, i, j = [], n, m
    rows: dict[int, np.ndarray] = {}

    def at(i: int, j: int) -> int:
        k = j - i - low
        return int(rows[i][k]) if 0 <= k < width else n + m + 1

    while i or j:
        if i and i - 1 not in rows:
            start = (i - 1) // every * every
            rows = {start: kept[start]}
            for k in range(start + 1, min(start + every, n) + 1):
                rows[k] = _row(rows[k - 1], a[k - 1], b, k + low)
        if not i:
            out += [INS] * j
            break
        now = at(i, j)
        if j and now == at(i - 1, j - 1) + (a[i - 1] != b[j - 1]):
            out.append(EQUAL if a[i - 1] == b[j - 1] else SUB)
            i, j = i - 1, j - 1
        elif now == at(i - 1, j) + 1:
            out.append(DEL)
            i -= 1
        else:
            out.append(INS)
            j -= 1
    return np.concatenate([np.array(out[::-1], np.int8), np.full(tail, EQUAL, np.int8)])


def places(ref: list[str], hyp: list[str]) -> list[int]:
    """For each reference word the place of the hypothesis word that it is aligned with or, where it has none, of the last
    one before (the first at the begin); -1 less the place unless both are equal."""
    ops = path(ref, hyp)
    here = np.maximum(np.cumsum(ops != DEL) - 1, 0)
    return np.where(ops == EQUAL, here, -1 - here)[ops != INS].tolist()


def _window(ops: np.ndarray) -> np.ndarray:
    """Without deletions and insertions before the first and after the last aligned pair; all where no pair is aligned."""
    pairs = np.flatnonzero(ops <= SUB)
    return ops[pairs[0] : pairs[-1] + 1] if len(pairs) else ops


def count(ref: list[str], hyp: list[str], windowed: bool = False) -> tuple[int, int, int, int, int, int]:
    """(S, D, I, C, n_ref, n_hyp); windowed: of the span from the first to the last aligned pair."""
    ops = path(ref, hyp)
    c, s, d, i = np.bincount(_window(ops) if windowed else ops, minlength=4).tolist()
    return s, d, i, c, s + d + c, s + i + c


def operations(ref: list[str], hyp: list[str]) -> list[tuple[str, str | None, str | None, int | None, int | None]]:
    """(operation, reference word, hypothesis word, their places) in order; NULL where a side has none."""
    out, i, j = [], 0, 0
    for op in path(ref, hyp).tolist():
        in_ref, in_hyp = op != INS, op != DEL
        out.append((NAMES[op], ref[i] if in_ref else None, hyp[j] if in_hyp else None, i if in_ref else None, j if in_hyp else None))
        i, j = i + in_ref, j + in_hyp
    return out


def _per_pair(f, kind: str):
    def run(ref: pd.Series, hyp: pd.Series) -> pd.Series:
        known: dict[tuple, object] = {}
        out = []
        for r, h in zip(ref, hyp):
            key = (tuple(r) if r is not None else (), tuple(h) if h is not None else ())
            if key not in known:
                known[key] = f(list(key[0]), list(key[1]))
            out.append(known[key])
        return pd.DataFrame(out, columns=["sub", "del", "ins", "cor", "n_ref", "n_hyp"]) if kind == COUNTS else pd.Series(out, dtype=object)

    run.__annotations__ = {"ref": pd.Series, "hyp": pd.Series, "return": pd.DataFrame if kind == COUNTS else pd.Series}
    return F.pandas_udf(run, kind)


def aligned(ref: Column, hyp: Column, windowed: bool = False) -> Column:
    """Counts of aligning two arrays of strings; NULL is the empty array."""
    return _per_pair(lambda r, h: count(r, h, windowed), COUNTS)(ref, hyp)


def aligned_ops(ref: Column, hyp: Column) -> Column:
    """The operations of aligning two arrays of strings, in order, with the places of both words."""
    names = ("op", "ref", "hyp", "ref_at", "hyp_at")
    return _per_pair(lambda r, h: [dict(zip(names, x)) for x in operations(r, h)], OPS)(ref, hyp)


def aligned_places(ref: Column, hyp: Column) -> Column:
    """places() of two arrays of strings: an integer a reference word."""
    return _per_pair(places, "array<int>")(ref, hyp)


def counts_of(ops: Column, windowed: bool = False) -> Column:
    """Counts of an array of operations."""
    pair = lambda x: x["op"].isin("EQUAL", "SUB")
    first = F.size(F.filter(ops, lambda x, i: ~F.exists(F.slice(ops, 1, i + 1), pair)))
    last = F.size(ops) - F.size(F.filter(ops, lambda x, i: ~F.exists(F.slice(ops, i + 1, F.size(ops)), pair)))
    part = F.when(F.exists(ops, pair), F.slice(ops, first + 1, F.greatest(last - first, F.lit(0)))).otherwise(ops) if windowed else ops
    n = lambda name: F.size(F.filter(part, lambda x: x["op"] == name))
    s, d, i, c = n("SUB"), n("DEL"), n("INS"), n("EQUAL")
    return F.struct(s.alias("sub"), d.alias("del"), i.alias("ins"), c.alias("cor"), (s + d + c).alias("n_ref"), (s + i + c).alias("n_hyp"))


def shown(ops: Column, most: int = 40) -> Column:
    """Three lines, reference, hypothesis and operation, of the first ``most`` operations, padded to equal widths."""
    word = lambda x, side: F.coalesce(x[side], F.lit("*"))
    mark = lambda x: F.when(x["op"] == "EQUAL", " ").otherwise(F.left(x["op"], F.lit(1)))
    width = lambda x: F.greatest(F.length(word(x, "ref")), F.length(word(x, "hyp")))
    line = lambda head, f: F.concat(F.lit(head), F.array_join(F.transform(F.slice(ops, 1, most), lambda x: F.rpad(f(x), width(x), F.lit(" "))), " "))
    return F.concat_ws("\n", line("REF: ", lambda x: word(x, "ref")), line("HYP: ", lambda x: word(x, "hyp")), line("     ", mark))


def errors(c: Column) -> Column:
    return c["sub"] + c["del"] + c["ins"]


def wer(c: Column) -> Column:
    """Errors a reference word; NULL where the reference is empty."""
    return F.try_divide(errors(c), c["n_ref"])


def gate_wer(c: Column) -> Column:
    """As wer, 0 where the reference is empty."""
    return F.coalesce(wer(c), F.lit(0.0))


def is_spurious(c: Column) -> Column:
    """Words where the reference has none."""
    return (c["n_ref"] == 0) & (c["ins"] > 0)
