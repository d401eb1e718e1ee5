"""Sources mixed to target shares by Poisson replication.

A document's number of copies is the inverse of a Poisson distribution, capped at its source's max_repeats, at a
uniform number hashed from its id and the seed. The rate is first the one whose capped mean is the source's target
repetition rate; it is then moved until the copies that these very numbers give hold the wanted tokens, which a count of
tokens by fine steps of the uniform number tells. Copies are exploded and put in a global order of hashed keys, by
ranges that are known beforehand as the keys are uniform.
"""

from __future__ import annotations

import base64
import functools
import math
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessitura.runtime import cut

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Sources that may have a target (more raise an error), and repeats of all of them together.
MAX_SOURCES, MAX_STEPS = 1_000, 1_000_000
#: Steps of the uniform number by which a source's tokens are counted, at most; all sources together have 2**20.
BINS = 1 << 14
#: Fixed value: how text is cut before byte pairs merge.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.lru_cache(maxsize=2)
def tokenizer(folder: str, vocabulary: str):
    """A public byte-pair vocabulary, loaded once a worker."""
    import tiktoken

    with open(os.path.join(folder, vocabulary), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_tokens(df: DataFrame, keep: list[str], text: str, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """The kept columns and n_tokens of the whole text (0 for NULL and empty texts)."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokenizer(folder, vocabulary)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(len(keep)).to_pylist()]
            yield pa.record_batch([*(b.column(i) for i in range(len(keep))), pa.array(n, pa.int64())], [*keep, "n_tokens"])

    rows = df.select(*keep, F.col(text).alias("_text"))
    return rows.mapInArrow(part, ", ".join(f"`{k}` {t}" for k, t in rows.select(*keep).dtypes) + ", n_tokens bigint")


def steps(rate: float, cap: int) -> list[float]:
    """P(copies <= k) for k = 0 .. cap-1: a document has as many copies as steps that its uniform number reaches."""
    if math.isinf(rate):
        return [0.0] * cap
    if rate <= 0:
        return [1.0] * cap
    out, total = [], 0.0
    for k in range(cap):
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        out.append(min(total, 1.0))
    return out


def capped_mean(rate: float, cap: int) -> float:
    """Mean of min(Poisson(rate), cap)."""
    return sum(1 - s for s in steps(rate, cap))


def _rate(holds, wanted: float) -> float:
    """The rate at which holds(rate), which grows with it, comes nearest to the wanted."""
    lo, hi = 0.0, 1.0
    while holds(hi) < wanted:
        lo, hi = hi, hi * 2
        if hi > 1e9:
            return math.inf
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if holds(mid) < wanted else (lo, mid)
    return min((lo, hi), key=lambda r: abs(holds(r) - wanted))


def rate_for(mean: float, cap: int) -> float:
    """The rate whose capped mean is the wanted one; infinite where only the cap itself will do."""
    return math.inf if mean >= cap * (1 - 1e-9) else _rate(lambda r: capped_mean(r, cap), mean)


def fitted_steps(cap: int, wanted: float, tokens: np.ndarray) -> list[float]:
    """The steps of the rate at which documents hold the wanted tokens; tokens are counted by equal steps of the uniform number."""
    n = len(tokens)
    above = np.append(np.cumsum(tokens[::-1])[::-1], 0)  # tokens from each step on

    def edges(rate: float) -> np.ndarray:
        return np.round(np.array(steps(rate, cap)) * n).astype(np.int64)

    if wanted >= cap * above[0]:
        return [0.0] * cap
    return (edges(_rate(lambda r: float(above[edges(r)].sum()), wanted)) / n).tolist()


def uniform(key: Column, seed: int, salt: str) -> Column:
    """A number in [0, 1) hashed from a key."""
    return F.shiftrightunsigned(F.xxhash64(key.cast("string"), F.lit(seed), F.lit(salt)), 11) / F.lit(float(1 << 53))


def plan(sizes: DataFrame, targets: DataFrame, total: float | None, key: str, seed: int) -> list[dict]:
    """Per target source: available documents and tokens, wanted tokens, steps.

    total is the wanted size of the mixture in tokens. By default it is the largest at which no present source must be
    repeated more than its cap allows, but at least half of the tokens that the target sources hold once.
    """
    wanted = targets.filter(F.col("target_share").isNotNull() & (F.col("source").isNotNull())).limit(MAX_SOURCES + 1).collect()
    if len(wanted) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} target sources")
    if sum(max(int(r["max_repeats"] or 0), 0) for r in wanted) > MAX_STEPS:
        raise ValueError(f"more than {MAX_STEPS} repeats in all")
    names = [r["source"] for r in wanted]
    bins = min(BINS, (1 << 20) // max(1, 1 << (len(names) - 1).bit_length() if names else 1))
    at = F.floor(uniform(F.col(key), seed, "copies") * bins).cast("int")
    counted = sizes.filter(F.col("source").isin(names)).groupBy("source", at.alias("bin")).agg(F.count("*").alias("n"), F.sum("n_tokens").alias("tokens")).toArrow()
    number = {name: i for i, name in enumerate(names)}
    row = np.array([number[x] for x in counted.column("source").to_pylist()], np.int64)
    tokens_of, docs_of = np.zeros((len(names), bins), np.int64), np.zeros(len(names), np.int64)
    np.add.at(tokens_of, (row, counted.column("bin").to_numpy()), counted.column("tokens").to_numpy())
    np.add.at(docs_of, row, counted.column("n").to_numpy())
    held, docs = dict(zip(names, tokens_of)), dict(zip(names, docs_of.tolist()))
    have = {name: int(held[name].sum()) for name in names}
    shares = sum(r["target_share"] for r in wanted) or 1.0
    budget = total
    if budget is None:
        room = [have[r["source"]] * max(int(r["max_repeats"] or 0), 0) * shares / r["target_share"] for r in wanted if have[r["source"]] and r["target_share"] > 0]
        once = float(sum(have.values()))
        budget = max(once / 2, min([once, *(x for x in room if x > 0)]))
    out = []
    for r in wanted:
        want, cap, tokens = budget * r["target_share"] / shares, max(int(r["max_repeats"] or 0), 0), have[r["source"]]
        fit = fitted_steps(cap, want, held[r["source"]]) if tokens and cap and want > 0 else []
        out.append({"source": r["source"], "target_share": r["target_share"] / shares, "max_repeats": cap, "n_docs": docs[r["source"]], "available": tokens, "wanted": want, "steps": fit})
    return out


def with_copies(df: DataFrame, plans: list[dict], source: str, key: str, seed: int, name: str) -> DataFrame:
    """Documents of the planned sources with their number of copies, where they have any. The plan has at most MAX_SOURCES
    rows and MAX_STEPS steps, so it is sent to every executor."""
    schema = "_source string, _steps array<double>"
    rows = df.sparkSession.createDataFrame([(p["source"], p["steps"]) for p in plans if p["steps"]], schema)
    u = uniform(F.col(key), seed, "copies")
    out = df.join(F.broadcast(rows), F.col(source) == F.col("_source")).withColumn(name, F.size(F.filter("_steps", lambda s: u >= s)))
    return out.filter(F.col(name) > 0).drop("_source", "_steps")


def token_sizes(docs: DataFrame, doc_id: str, source: str, text: str, **tok) -> DataFrame:
    """(doc_id, source, n_tokens), kept in the shared checkpoint folder: texts are tokenized once."""
    return cut(with_tokens(docs, [doc_id, source], text, **tok).withColumnRenamed(source, "source"))


def in_order(df: DataFrame, key: str, then: str) -> DataFrame:
    """df globally ordered by a key that is uniform over all longs: partition i holds the i-th range of keys, so nothing
    is sampled and df is computed once."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # for each partition a number that Spark's hash sends there
    to = spark.range(40 * n).groupBy(F.pmod(F.hash(F.col("id").cast("int")), F.lit(n)).alias("p")).agg(F.min("id").alias("id")).collect()
    if len(to) < n:
        return df.orderBy(key, then)
    sent = F.array(*[F.lit(int(r["id"])) for r in sorted(to, key=lambda r: r["p"])])
    range_ = F.least(F.lit(n - 1), F.floor((F.col(key) / F.lit(float(1 << 64)) + 0.5) * n).cast("int"))
    return df.withColumn("_range", F.element_at(sent, range_ + 1)).repartition(n, "_range").sortWithinPartitions(key, then).drop("_range")


def mix(docs: DataFrame, targets: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: int = 42, total: float | None = None, **tok) -> DataFrame:
    """The mixture: all columns of docs, copy (from 1) and position key mix_key, globally ordered by that key.

    Documents of sources without a target, or with a NULL source, have share 0. No document of a source is repeated
    more than max_repeats times. NULL and empty texts have size 0 and are repeated like others of their source. Columns
    copy and mix_key of docs are replaced.
    """
    docs = docs.drop("copy", "mix_key")
    plans = plan(token_sizes(docs, doc_id, source, text, **tok), targets, total, doc_id, seed)
    out = with_copies(docs, plans, source, doc_id, seed, "_copies").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies")
    return in_order(out.withColumn("mix_key", F.xxhash64(F.col(doc_id).cast("string"), "copy", F.lit(seed), F.lit("order"))), "mix_key", doc_id)


def shares(docs: DataFrame, targets: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: int = 42, total: float | None = None, **tok) -> DataFrame:
    """Per target source: target and actual share of the mixture's tokens, documents, copies, most repeats, shortfall.

    shortfall_tokens is what the source stays below its wanted tokens (all of them for an absent source).
    """
    sizes = token_sizes(docs, doc_id, source, text, **tok)
    plans = plan(sizes, targets, total, doc_id, seed)
    used = with_copies(sizes, plans, "source", doc_id, seed, "_n")
    got = used.groupBy("source").agg(F.count("*").alias("docs_used"), F.sum("_n").alias("copies"), F.max("_n").alias("most_repeats"), F.sum(F.col("_n") * F.col("n_tokens")).alias("tokens"))
    names = "source string, target_share double, max_repeats int, n_docs bigint, available_tokens bigint, wanted_tokens double"
    base = docs.sparkSession.createDataFrame([(p["source"], p["target_share"], p["max_repeats"], p["n_docs"], p["available"], p["wanted"]) for p in plans], names)
    out = base.join(got, "source", "left").na.fill(0, ["docs_used", "copies", "most_repeats", "tokens"])
    whole = got.agg(F.sum("tokens").alias("all_tokens"))
    return out.join(F.broadcast(whole)).select(
        "source", "target_share", F.try_divide("tokens", "all_tokens").alias("actual_share"), "max_repeats", "n_docs", "docs_used", "copies", "most_repeats", "available_tokens", "wanted_tokens", "tokens",
        F.greatest(F.col("wanted_tokens") - F.col("tokens"), F.lit(0.0)).alias("shortfall_tokens"),
    )
