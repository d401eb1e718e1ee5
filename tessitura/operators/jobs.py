"""Control tables: job and address states, timings, progress, chunking, set updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessitura.runtime import cut

ACTIVE = ("queued", "running", "completed", "skipped")
STATES = ("completed", "failed", "skipped", "running", "queued")


def stage_timings(df: DataFrame, by: list[str], seconds: str) -> DataFrame:
    """Total, count and mean seconds of each group; a NULL key is its own group."""
    return df.groupBy(*by).agg(F.round(F.coalesce(F.sum(seconds), F.lit(0.0)), 3).alias("total_sec"), F.count("*").alias("n"), F.round(F.coalesce(F.avg(seconds), F.lit(0.0)), 3).alias("avg_sec"))


def state_counts(df: DataFrame, by: list[str], status: str) -> DataFrame:
    """Rows in all, and in each known state."""
    return df.groupBy(*by).agg(F.count("*").alias("total"), *[F.count_if(F.col(status) == s).alias(f"n_{s}") for s in STATES])


def batch_status(df: DataFrame, by: list[str], status: str) -> DataFrame:
    """The state of a batch from those of its jobs."""
    s = F.col(status)
    all_, any_ = (lambda v: F.coalesce(F.bool_and(s == v), F.lit(False))), (lambda v: F.coalesce(F.bool_or(s == v), F.lit(False)))
    state = F.when(all_("completed"), "completed").when(any_("failed"), "failed").when(any_("running"), "running").when(any_("blocked"), "blocked").when(all_("queued"), "queued").otherwise("running")
    return df.groupBy(*by).agg(state.alias("batch_status"))


def drill_down(df: DataFrame, key: str, address: str, order: str, fields: list[str], parent: Column, seconds: str) -> DataFrame:
    """Per key: the first address in order, total of parent rows, and the number and ordered list of rows."""
    item = F.struct(F.col(order), *[F.col(f) for f in fields])
    return df.groupBy(F.coalesce(F.col(key), F.lit("")).alias(key)).agg(
        F.min_by(address, F.when(F.col(address).isNotNull(), F.col(order))).alias("first_url"),
        F.round(F.coalesce(F.sum(F.when(parent, F.col(seconds))), F.lit(0.0)), 3).alias("parent_sec"),
        F.count("*").alias("n_rows"),
        F.array_sort(F.collect_list(item)).alias("rows"),
    )


def active(df: DataFrame, urls: DataFrame, key: str, status: str = "status") -> DataFrame:
    """Rows of df whose key is among the active addresses."""
    return df.join(urls.filter(F.col(status).isin(*ACTIVE)).select(key).distinct(), key, "left_semi")


def not_done(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of df whose key isn't among those done."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def block_siblings(df: DataFrame, batch: str, status: str) -> DataFrame:
    """Queued jobs of a batch that has a blocked one become blocked."""
    hit = df.filter(F.col(status) == "blocked").select(F.col(batch).alias("_b")).distinct()
    out = df.join(hit, F.col(batch) == F.col("_b"), "left")
    return out.withColumn(status, F.when((F.col(status) == "queued") & F.col("_b").isNotNull(), "blocked").otherwise(F.col(status))).drop("_b")


def resume(df: DataFrame, status: str) -> DataFrame:
    """Running and failed rows go back to the queue."""
    return df.withColumn(status, F.when(F.col(status).isin("running", "failed"), "queued").otherwise(F.col(status)))


def numbered(df: DataFrame, order: list[Column], name: str = "row_no") -> DataFrame:
    """Consecutive numbers from 0 in a global order, without one task that sorts all rows.

    Rows are range-partitioned and kept, as ranges are sampled and must not differ between the two reads; a partition's
    numbers begin after the rows of those before it (one count a partition).
    """
    keyed = cut(df.withColumn("_o", F.struct(*order)).repartitionByRange(F.col("_o")).withColumn("_p", F.spark_partition_id()))
    inner = keyed.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy("_o")) - 1)
    sizes = keyed.groupBy("_p").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return inner.join(F.broadcast(sizes.select("_p", "_before")), "_p").withColumn(name, F.col("_r") + F.col("_before")).drop("_o", "_p", "_r", "_before")


def chunked(df: DataFrame, by: str, order: str, size: int) -> DataFrame:
    """chunk_no of each row within its group: consecutive rows in chunks of max(1, size)."""
    n = F.row_number().over(Window.partitionBy(by).orderBy(order)) - 1
    return df.withColumn("chunk_no", F.floor(n / max(1, size)))


def first_seen(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row of each key in order; NULL and blank keys go."""
    k = df.withColumn("_k", key).filter(F.length(F.trim("_k")) > 0)
    row = F.struct(*df.columns)
    return k.groupBy("_k").agg(F.min_by(row, F.col(order)).alias("_row")).select("_row.*")


def latest(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by the order columns (aggregated before the exchange, so hot keys stay small)."""
    return df.groupBy(*key).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_row")).select("_row.*")


def window_of(df: DataFrame, position: str, cursor: int, size: int, total: int) -> DataFrame:
    """A circular window of ``size`` rows from a cursor over positions 0 .. total-1."""
    at = F.pmod(F.col(position) - cursor, F.lit(max(total, 1)))
    return df.filter(at < size).withColumn("window_idx", at)


def run_delta(df: DataFrame, run: str, stage: str, value: str) -> DataFrame:
    """Change of a stage's value from one run to the next."""
    return df.withColumn("delta", F.col(value) - F.lag(value).over(Window.partitionBy(stage).orderBy(run)))


def label_ids(df: DataFrame, label: str, known: dict[str, int]) -> DataFrame:
    """(label, label_id): known ids stay, the other labels in order take the smallest free ids.

    The distinct labels are numbered by ranges, however many they are.
    """
    names = df.select(label).filter(F.col(label).isNotNull()).distinct()
    given = F.lit(None).cast("int")
    for k, v in known.items():
        given = F.when(F.col(label) == k, v).otherwise(given)
    out = names.withColumn("_id", given)
    rest = numbered(out.filter("_id is null"), [F.col(label)], "_n")
    taken = sorted(set(known.values()))
    free = F.col("_n")
    for t in taken:
        free = F.when(free >= t, free + 1).otherwise(free)
    return out.filter("_id is not null").select(label, F.col("_id").alias("label_id")).unionByName(rest.select(label, free.cast("int").alias("label_id")))
