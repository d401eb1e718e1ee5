"""Ordering, slicing, quotas, histories and joins of control tables: what lists, pages and resumes rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessitura.operators.jobs import numbered


def newest(df: DataFrame, at: str, tie: str, n: int | None = None, most: int = 200) -> DataFrame:
    """Rows newest first; n (within 1 and ``most``) keeps as many, by a top-k in every partition first."""
    out = df.orderBy(F.desc(at), F.desc(tie))
    return out if n is None else out.limit(max(1, min(n, most)))


def sliced(df: DataFrame, order: list[Column], begin: int, end: int = 0) -> DataFrame:
    """Rows begin (counted from 0) to end, exclusive, of an order; end 0 means to the last. Adds row_no."""
    rows = numbered(df, order)
    return rows.filter((F.col("row_no") >= begin) & ((F.col("row_no") < end) if end else F.lit(True)))


def longest_first(df: DataFrame, phrase: str) -> DataFrame:
    """Distinct phrases, longer ones first, then by name."""
    return df.select(phrase).distinct().orderBy(F.desc(F.length(phrase)), phrase)


def within_quota(df: DataFrame, query: str, key: str, score: str, limit: int, n_queries: int, taken: DataFrame | None = None) -> DataFrame:
    """At most ``limit`` rows: of each query its best max(1, limit // n_queries) of positive score, each key once, none
    that is taken already; queries in order, best first."""
    good = df.filter(F.col(score) > 0)
    if taken is not None:
        good = good.join(taken.select(key).distinct(), key, "left_anti")
    once = good.groupBy(key).agg(F.min_by(F.struct(*[c for c in df.columns if c != key]), F.struct(query, (-F.col(score)).alias("s"))).alias("_r")).select(key, "_r.*")
    rank = F.row_number().over(Window.partitionBy(query).orderBy(F.desc(score), key))
    return once.withColumn("_n", rank).filter(F.col("_n") <= max(1, limit // max(1, n_queries))).orderBy(query, "_n").limit(limit).drop("_n")


def step_history(df: DataFrame, job: str, at: str, step: str, first: str) -> DataFrame:
    """Steps with their end, which is the next step's start (NULL for the last), and run_no: a step ``first`` begins a
    new run of its job. Repeated notices of the step that is open begin nothing."""
    w = Window.partitionBy(job).orderBy(at)
    out = df.withColumn("_same", F.coalesce((F.lag(step).over(w) == F.col(step)) & (F.col(step) != first), F.lit(False))).filter(~F.col("_same")).drop("_same")
    return out.withColumn("run_no", F.sum((F.col(step) == first).cast("int")).over(w)).withColumn("ended_at", F.lead(at).over(w))


def with_children(parents: DataFrame, children: DataFrame, key: str, foreign: str, order: str, fields: list[str]) -> DataFrame:
    """Parents with n_children and the last ordered child's fields beside them, in long form: a row a child, one with
    NULLs for a parent without any; child_no counts from 1."""
    c = children.select(F.col(foreign).alias("_k"), *[F.col(f).alias(f"child_{f}") for f in fields], F.row_number().over(Window.partitionBy(foreign).orderBy(order)).alias("child_no"))
    return parents.join(c, F.col(key) == F.col("_k"), "left").drop("_k")


def requeued(jobs: DataFrame, urls: DataFrame, job: str, foreign: str, status: str = "status", states: tuple[str, ...] = ("failed", "blocked")) -> DataFrame:
    """Jobs in one of the states that have a queued address go back to the queue; all rows stay."""
    open_ = urls.filter(F.col(status) == "queued").select(F.col(foreign).alias("_q")).distinct()
    out = jobs.join(open_, F.col(job) == F.col("_q"), "left")
    return out.withColumn(status, F.when(F.col("_q").isNotNull() & F.col(status).isin(*states), "queued").otherwise(F.col(status))).drop("_q")


def changed_status(df: DataFrame, where: Column, old: str, new: str, status: str = "status") -> DataFrame:
    """df with rows of status old that meet the condition set to new, and was_changed, whose sum is the number of them."""
    hit = F.coalesce(where & (F.col(status) == old), F.lit(False))
    return df.withColumn("was_changed", hit).withColumn(status, F.when(hit, new).otherwise(F.col(status)))


def first_positive(*columns: Column) -> Column:
    """The first of the values that is above 0, else NULL."""
    return F.coalesce(*[F.when(c > 0, c) for c in columns])


def listed(text: Column, separators: str = r"[\n;]+") -> Column:
    """Parts of a list in text, trimmed, without blank ones; [] for NULL."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), separators), lambda x: F.trim(x)), lambda x: x != "")


def cursor(text: Column, name: str = "cursor") -> Column:
    """A whole number of a JSON object; 0 where it is missing or no number."""
    return F.coalesce(F.get_json_object(text, f"$.{name}").try_cast("int"), F.lit(0))


def number(text: Column) -> Column:
    """A number in text; NULL for blank and other text."""
    return F.when(F.trim(text) != "", F.trim(text).try_cast("double"))


def host_label(address: Column) -> Column:
    """scheme://host:port of an address, without user and password; 'invalid' for what is none."""
    m = lambda i: F.regexp_extract(address, r"^(\w+)://(?:[^@/]*@)?([^:/@]+):(\d+)", i)
    return F.when(F.coalesce(m(1), F.lit("")) != "", F.concat(m(1), F.lit("://"), m(2), F.lit(":"), m(3))).otherwise("invalid")


def signed(seconds: Column) -> Column:
    """A difference as text, with its sign unless it is 0."""
    return F.when(seconds == 0, "0.0s").otherwise(F.format_string("%+.1fs", seconds))


def snapshot(**columns: Column) -> Column:
    """Parameters as a JSON object, NULLs left out."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in columns.items()]))


def params_text(**columns: Column) -> Column:
    """name=value of each parameter that is given, in order."""
    return F.concat_ws(" ", *[F.when(c.isNotNull(), F.concat(F.lit(k + "="), c.cast("string"))) for k, c in columns.items()])


def labelling_tasks(lines: DataFrame, value: str = "value", prefix: str = "audio") -> DataFrame:
    """(audio, text) of lines ``path<TAB>text``: the address of the file's name under prefix, white space squeezed; lines
    of other than two columns have text ''. Blank lines are left out."""
    p = F.split(F.col(value), "\t")
    name = F.element_at(F.split(F.trim(p[0]), "/"), -1)
    said = F.when(F.size(p) == 2, F.trim(F.regexp_replace(F.get(p, F.lit(1)), r"(?U)\s+", " "))).otherwise("")
    return lines.filter(F.trim(F.col(value)) != "").select(F.concat(F.lit(f"/data/local-files/?d={prefix}/"), name).alias("audio"), said.alias("text"))


def catalogue(audio: DataFrame, captions: DataFrame, path: str = "path") -> DataFrame:
    """Audio files with the caption file of their video (path_caption NULL if none), by the id before the name's __."""
    name = F.regexp_replace(F.element_at(F.split(F.col(path), "/"), -1), r"\.[^.]*$", "")
    a = audio.withColumn("video_id", F.regexp_replace(F.split(name, "__")[0], "^yt_", ""))
    return a.join(captions.select("video_id", F.col("path").alias("path_caption")), "video_id", "left")
