"""Merged periods and gaps of integer intervals through canonical dyadic blocks.

Time is cut into cells of 2**CELL ms. Within a cell every interval becomes at most two blocks a level; blocks that lie
in a larger block go, sibling pairs become their parent, and neighbouring blocks coalesce. Cells of one entity go to
different tasks, so an entity of any size is spread; a cell holds at most 2**CELL rows, as of the intervals that begin
at the same millisecond only the longest is kept before the exchange. What crosses cell borders is joined afterwards
from at most two fragments a cell. Intervals over many cells keep their canonical blocks above the cells, so that one of
any length is a few dozen rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessitura.runtime import cut

CELL = 20
#: Cells that an interval is written to; a longer one is kept as blocks of higher levels.
LONG = 64


def dyadic_blocks(starts: np.ndarray, ends: np.ndarray, top: int = CELL) -> list[np.ndarray]:
    """Sorted distinct canonical blocks by level (block b of level k covers [b<<k, (b+1)<<k)) of half-open intervals."""
    lo, hi, levels = starts.astype(np.int64), ends.astype(np.int64), []
    for level in range(top + 1):
        alive = lo < hi
        lo, hi = lo[alive], hi[alive]
        if level == top:
            levels.append(np.unique(np.concatenate([lo, hi - 1])))
            break
        left, right = (lo & 1) == 1, (hi & 1) == 1
        levels.append(np.unique(np.concatenate([lo[left], hi[right] - 1])))
        lo, hi = (lo + left) >> 1, (hi - right) >> 1
    return levels


def drop_covered(levels: list[np.ndarray]) -> list[np.ndarray]:
    """Without the blocks that an ancestor covers; what is left doesn't overlap."""
    kept: list[np.ndarray] = [np.empty(0, np.int64)] * len(levels)
    begin = end = np.empty(0, np.int64)
    for level in range(len(levels) - 1, -1, -1):
        first = levels[level] << level
        at = np.searchsorted(begin, first, side="right") - 1
        covered = (at >= 0) & (end[np.maximum(at, 0)] > first) if len(begin) else np.zeros(len(first), bool)
        kept[level] = levels[level][~covered]
        first = first[~covered]
        begin, end = np.concatenate([begin, first]), np.concatenate([end, first + (1 << level)])
        order = np.argsort(begin, kind="stable")
        begin, end = begin[order], end[order]
    return kept


def merge_siblings(levels: list[np.ndarray]) -> list[np.ndarray]:
    """Pairs of sibling blocks become their parent, level by level."""
    out = list(levels)
    for level in range(len(out) - 1):
        b = out[level]
        if len(b) < 2:
            continue
        pair = np.flatnonzero((b[:-1] & 1 == 0) & (b[1:] == b[:-1] + 1))
        if len(pair):
            out[level + 1] = np.unique(np.concatenate([out[level + 1], b[pair] >> 1]))
            out[level] = np.delete(b, np.concatenate([pair, pair + 1]))
    return out


def coalesce(levels: list[np.ndarray], top: int = CELL) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of adjacent blocks that don't cross a multiple of 2**top, as sorted starts and ends."""
    begin = np.concatenate([b << k for k, b in enumerate(levels)])
    end = np.concatenate([(b + 1) << k for k, b in enumerate(levels)])
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], end[order]
    if not len(begin):
        return begin, end
    new = np.concatenate([[True], (begin[1:] != end[:-1]) | (begin[1:] >> top != begin[:-1] >> top)])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(begin) - 1]])
    return begin[new], end[last]


def union_in_cells(cell: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of intervals within numbered cells; starts and ends are offsets in [0, 2**CELL]."""
    base = cell.astype(np.int64) << CELL
    begin, end = coalesce(merge_siblings(drop_covered(dyadic_blocks(base + starts, base + ends))))
    at = begin >> CELL
    return at, begin - (at << CELL), end - (at << CELL)


def _cells_to_periods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (entity columns, _cell, _lo, _hi) sorted by entity and cell → periods clipped to cells, with their neighbour."""
    rest: pa.Table | None = None

    def work(t: pa.Table) -> pa.RecordBatch:
        keys = t.column_names[:-2]
        number = _changes(t, keys).cumsum() - 1
        s, e = (t.column(c).to_numpy() for c in ("_lo", "_hi"))
        at, begin, end = union_in_cells(number, s, e)
        lead = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))[at]
        same = np.concatenate([[False], at[1:] == at[:-1]]) if len(at) else np.empty(0, bool)
        final = np.concatenate([at[1:] != at[:-1], [True]]) if len(at) else np.empty(0, bool)
        shift = t.column("_cell").to_numpy()[lead].astype(np.int64) << CELL
        out = {k: t.column(k).take(pa.array(lead)) for k in keys}
        out |= {
            "begin_ms": pa.array(begin + shift),
            "end_ms": pa.array(end + shift),
            "prev_end_ms": pa.array(np.concatenate([[0], end[:-1]]) + shift if len(end) else end, mask=~same),
            "last_in_cell": pa.array(final),
        }
        return pa.table(out).combine_chunks().to_batches()[0]

    for batch in batches:
        t = pa.Table.from_batches([batch])
        if rest is not None:
            t = pa.concat_tables([rest, t]).combine_chunks()
        if not t.num_rows:
            continue
        begins = np.flatnonzero(_changes(t, t.column_names[:-2]))
        rest = t.slice(begins[-1])
        if begins[-1]:
            yield work(t.slice(0, begins[-1]).combine_chunks())
    if rest is not None and rest.num_rows:
        yield work(rest)


def _changes(t: pa.Table, keys: list[str]) -> np.ndarray:
    """Where a row's keys differ from those of the row before."""
    new = np.zeros(t.num_rows, bool)
    new[:1] = True
    for k in keys:
        c = t.column(k).combine_chunks()
        if pa.types.is_string(c.type):
            c = c.dictionary_encode()
            c = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c).indices
        v = c.to_numpy(zero_copy_only=False)
        new[1:] |= v[1:] != v[:-1]
    return new


def to_ms(seconds: Column) -> Column:
    """Seconds as rounded integer milliseconds; NULL for NaN and for what no long can hold (9e15 seconds and more)."""
    s = seconds.cast("double")
    return F.when(F.abs(s) < 9.0e15, F.round(s * 1000).cast("bigint"))


def _high_blocks(rows: DataFrame, entity: list[str]) -> DataFrame:
    """(entity, level, block): canonical blocks, in cells, of what long intervals cover between their end cells; two a
    level at most."""
    blocks = F.expr(
        f"flatten(transform(sequence(0, {62 - CELL}), k -> filter(array("
        "if(-shiftright(-_lo, k) < shiftright(_hi, k) and shiftright(_lo + shiftleft(1L, k) - 1, k) % 2 != 0, named_struct('level', k, 'block', -shiftright(-_lo, k)), null),"
        "if(-shiftright(-_lo, k) < shiftright(_hi, k) and shiftright(_hi, k) % 2 != 0, named_struct('level', k, 'block', shiftright(_hi, k) - 1), null)), x -> x is not null)))"
    )
    inner = rows.filter(F.col("_last") - F.col("_first") > LONG).select(*entity, (F.col("_first") + 1).alias("_lo"), F.col("_last").alias("_hi"))
    return inner.select(*entity, F.explode(blocks).alias("_b")).select(*entity, F.col("_b.level").alias("_level"), F.col("_b.block").alias("_block")).distinct()


def _cell_periods(df: DataFrame, entity: list[str], start_ms: str, end_ms: str) -> DataFrame:
    """Periods clipped to cells, with their neighbours. An interval goes to every cell that it meets or, where these are
    more than LONG, to its end cells and to the few blocks of higher levels between them; cells in such a block are
    covered and go."""
    ok = F.col(start_ms).isNotNull() & F.col(end_ms).isNotNull() & (F.col(end_ms) > F.col(start_ms))
    for k in entity:
        ok &= F.col(k).isNotNull()
    rows = df.filter(ok).select(*entity, F.col(start_ms).alias("_s"), F.col(end_ms).alias("_e"))
    rows = rows.withColumns({"_first": F.shiftright("_s", CELL), "_last": F.shiftright(F.col("_e") - 1, CELL)})
    long_ = F.col("_last") - F.col("_first") > LONG
    cells = F.when(long_, F.array("_first", "_last")).otherwise(F.sequence("_first", F.when(long_, F.col("_first")).otherwise(F.col("_last"))))
    base = F.shiftleft(F.col("_cell"), CELL)
    pieces = (
        rows.withColumn("_cell", F.explode(cells))
        .select(
            *entity,
            "_cell",
            (F.greatest("_s", base) - base).cast("int").alias("_lo"),
            (F.least(F.col("_e"), base + (1 << CELL)) - base).cast("int").alias("_hi"),
        )
        .groupBy(*entity, "_cell", "_lo")
        .agg(F.max("_hi").alias("_hi"))
    )
    schema = ", ".join([*(f"`{k}` {t}" for k, t in pieces.select(*entity).dtypes), "_cell bigint", "begin_ms bigint", "end_ms bigint", "prev_end_ms bigint", "last_in_cell boolean"])
    parts = (
        pieces.select(*entity, "_cell", "_lo", "_hi")
        .repartition(*entity, "_cell")
        .sortWithinPartitions(*entity, "_cell")
        .mapInArrow(_cells_to_periods, schema)
    )
    if rows.filter(long_).isEmpty():
        return parts
    high = cut(_high_blocks(rows, entity))
    levels = [r[0] for r in high.select("_level").distinct().collect()]  # 43 at most
    of = F.explode(F.array(*[F.struct(F.lit(k).alias("_level"), F.shiftright("_cell", k).alias("_block")) for k in levels])).alias("x")
    met = parts.select(*entity, "_cell").distinct().select(*entity, "_cell", of).select(*entity, "_cell", "x.*")
    covered = met.join(high, [*entity, "_level", "_block"], "left_semi").select(*entity, "_cell").distinct()
    begin = F.expr(f"shiftleft(_block, _level + {CELL})")
    end = F.expr(f"shiftleft(_block + 1, _level + {CELL})")
    blocks = high.select(*entity, F.expr("shiftleft(_block, _level)").alias("_cell"), begin.alias("begin_ms"), end.alias("end_ms"), F.lit(None).cast("bigint").alias("prev_end_ms"), F.lit(True).alias("last_in_cell"))
    return parts.join(covered, [*entity, "_cell"], "left_anti").unionByName(blocks)


def merge_intervals(df: DataFrame, entity: list[str], start_ms: str, end_ms: str) -> DataFrame:
    """Continuous periods (entity, begin_ms, end_ms) of half-open integer intervals; what overlaps or touches is one.

    Rows with a NULL entity or bound, or whose end isn't after the start, are ignored; an empty input gives no period.
    """
    parts = _cell_periods(df, entity, start_ms, end_ms)
    base = F.shiftleft(F.col("_cell"), CELL)
    edge = (F.col("begin_ms") == base) | (F.col("end_ms") == base + (1 << CELL))
    # Only fragments that reach a cell border can be part of a longer period; the others stay with their cell.
    w = Window.partitionBy(*entity, "_at").orderBy("begin_ms")
    reached = F.max("end_ms").over(w.rowsBetween(Window.unboundedPreceding, -1))  # blocks of higher levels may nest
    new = ~(F.col("_edge") & F.coalesce(reached >= F.col("begin_ms"), F.lit(False)))
    return (
        parts.withColumn("_edge", edge)
        .withColumn("_at", F.when(~F.col("_edge"), F.col("_cell")))
        .withColumn("_new", new.cast("int"))
        .withColumn("_run", F.sum("_new").over(w))
        .groupBy(*entity, "_at", "_run")
        .agg(F.min("begin_ms").alias("begin_ms"), F.max("end_ms").alias("end_ms"))
        .select(*entity, "begin_ms", "end_ms")
    )


def interval_gaps(df: DataFrame, entity: list[str], start_ms: str, end_ms: str, below_ms: int | None = None) -> DataFrame:
    """Gaps (entity, gap_start_ms, gap_end_ms) between successive periods; below_ms leaves out gaps of that length or more.

    Gaps inside a cell are complete there; for those across cells each cell hands on its first start and last end, so
    the window over an entity has one row per 2**CELL ms of its length.
    """
    parts = _cell_periods(df, entity, start_ms, end_ms)
    inner = F.when(F.col("prev_end_ms").isNotNull(), F.struct(F.col("prev_end_ms").alias("a"), F.col("begin_ms").alias("b")))
    rows = parts.select(
        *entity,
        F.explode(
            F.filter(
                F.array(
                    F.struct(inner.alias("gap"), F.lit(None).cast("bigint").alias("first"), F.lit(None).cast("bigint").alias("last")),
                    F.struct(
                        F.lit(None).cast("struct<a:bigint,b:bigint>").alias("gap"),
                        F.when(F.col("prev_end_ms").isNull(), F.col("begin_ms")).alias("first"),
                        F.when(F.col("last_in_cell"), F.col("end_ms")).alias("last"),
                    ),
                ),
                lambda x: x["gap"].isNotNull() | x["first"].isNotNull() | x["last"].isNotNull(),
            )
        ).alias("r"),
    ).select(*entity, "r.*")
    if below_ms is not None:
        rows = rows.filter(F.col("gap").isNull() | (F.col("gap.b") - F.col("gap.a") < below_ms))
    # Finished gaps get a partition of their own beside the entity's borders, so that one exchange serves both.
    w = Window.partitionBy(*entity, "_side").orderBy("_pos")
    rows = (
        rows.withColumn("_side", F.when(F.col("gap").isNotNull(), F.shiftright(F.col("gap.a"), CELL)))
        .withColumn("_pos", F.coalesce("first", "last", "gap.a"))
        .withColumn("_before", F.max(F.when(F.col("gap").isNull(), F.col("last"))).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    )
    a = F.when(F.col("gap").isNotNull(), F.col("gap.a")).otherwise(F.col("_before"))
    b = F.when(F.col("gap").isNotNull(), F.col("gap.b")).otherwise(F.col("first"))
    out = rows.select(*entity, a.alias("gap_start_ms"), b.alias("gap_end_ms")).filter(F.col("gap_end_ms") > F.col("gap_start_ms"))
    return out if below_ms is None else out.filter(F.col("gap_end_ms") - F.col("gap_start_ms") < below_ms)
