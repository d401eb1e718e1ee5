"""Splits that keep related records together: components of shared keys, then grouped iterative stratification.

Components: every row is an anchor; an attribute value ties its rows to the least anchor that has it, first within
SALTS parts of its anchors, then across the parts, so that a value on a third of all rows is spread. Values with one
anchor (nearly all) leave no edge. The edges that are left are contracted by alternating large-star and small-star
steps with checkpoints, salted in the same way.

Stratification: components with their label vectors are placed rarest outstanding label first into the split that needs
it most. All are placed at once, by the driver, as classes with the number of components that have them: a class is a
label vector, however many vectors there are. A last pass moves components between splits while that brings rows and labels nearer to their
targets. The components of a class are then numbered and take the places in order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessitura.runtime import cut

#: Parts in which the components of one class are numbered, and parts of the anchors of one value.
PARTS, SALTS = 512, 16
#: Labels that can be balanced (more raise an error), classes that the last pass weighs at once (the result doesn't depend
#: on it), and moves of the last pass.
MAX_LABELS, MAX_CLASSES, MOVES = 1_000, 50_000, 2_000
SWAPS, ROWS = 200, 8


def video_key(url: Column) -> Column:
    """The v= key of an address, or NULL; case counts."""
    key = F.regexp_extract(url, r"[?&;]v=([^&#;\s]+)", 1)
    return F.when(F.length(key) > 0, key)


def _present(c: Column) -> Column:
    return F.when(F.length(F.regexp_replace(c, r"[\s ]+", "")) > 0, c)


def _part(c: str) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(SALTS)).cast("int")


def _with_least(pairs: DataFrame, least: DataFrame) -> DataFrame:
    """pairs (a, b) with m of least (a, m), joined on a and a part of b, as one a may have a third of all pairs."""
    spread = least.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return pairs.withColumn("s", _part("b")).join(spread, ["a", "s"]).select("a", "b", "m")


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(node, root) for edges (a, b): root is the least node of the component. Large-star and small-star by turns."""

    def kept(df: DataFrame) -> tuple[DataFrame, tuple]:
        out = cut(df)
        return out, tuple(out.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).head())

    now, mark = kept(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(max_rounds):
        if not mark[0]:
            break
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _with_least(both, least).filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(F.col("a") != F.col("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        ends = F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        small = _with_least(down, low).select(F.explode(ends).alias("e")).select("e.*").filter(F.col("a") != F.col("b")).distinct()
        before, (now, mark) = mark, kept(small)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def tie_rows(df: DataFrame, keys: dict[str, Column]) -> tuple[DataFrame, Column]:
    """((node, root) of tied anchors, the anchor): an anchor is the row's first key that isn't NULL, with its name."""
    named = {k: F.concat(F.lit(k + ":"), c) for k, c in keys.items()}
    anchor = F.coalesce(*named.values())
    combos = df.select(anchor.alias("anchor"), *[c.alias(f"_k{i}") for i, c in enumerate(named.values())]).filter(F.col("anchor").isNotNull()).distinct()
    held = combos.select("anchor", F.explode(F.array_compact(F.array(*[f"_k{i}" for i in range(len(named))]))).alias("value")).distinct().withColumn("s", _part("anchor"))
    near = held.groupBy("value", "s").agg(F.min("anchor").alias("least"), F.max("anchor").alias("most"))
    inner = held.join(near.filter(F.col("least") != F.col("most")).drop("most"), ["value", "s"]).select(F.col("anchor").alias("a"), F.col("least").alias("b"))
    heads = near.groupBy("value").agg(F.min("least").alias("b"), F.collect_list("least").alias("all")).select(F.explode("all").alias("a"), "b")  # SALTS at most
    return components(inner.unionByName(heads).filter(F.col("a") != F.col("b")).distinct()), anchor


def recording_keys(video: str = "video_id", audio: str = "audio_id", segment: str = "segment_id", url: str = "source_url") -> dict[str, Column]:
    """What ties segments of one recording: non-blank ids, and the v= key of the address."""
    return {"v": _present(F.col(video)), "a": _present(F.col(audio)), "k": video_key(F.col(url)), "s": _present(F.col(segment))}


def _own(df: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """(root, id) of the values of the first key that are tied to anything."""
    roots, _ = tie_rows(df, keys)
    first = next(iter(keys)) + ":"
    own = roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct().filter(F.col("node").startswith(first))
    return own.select("root", F.col("node").substr(F.lit(len(first) + 1), F.length("node")).alias("id"))


def tied_pairs(df: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """(a, b), a < b: pairs of different values of the first key that belong together.

    Rows whose keys are all NULL tie nothing; repeated rows change nothing; an empty table gives no rows.
    """
    own = _own(df, keys)
    a, b = own.select("root", F.col("id").alias("a")), own.select("root", F.col("id").alias("b"))
    return a.join(b, "root").filter(F.col("a") < F.col("b")).select("a", "b")


def groups(df: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """(id, group_id): each value of the first key once, with the least value that it belongs with (itself if alone)."""
    own = cut(_own(df, keys))
    least = own.groupBy("root").agg(F.min("id").alias("group_id"))
    tied = own.join(least, "root").select("id", "group_id")
    all_ = df.select(next(iter(keys.values())).alias("id")).filter(F.col("id").isNotNull()).distinct()
    return all_.join(tied, "id", "left").select("id", F.coalesce("group_id", "id").alias("group_id"))


def place(labels: np.ndarray, want: np.ndarray) -> np.ndarray:
    """Split number of each component. labels: components x labels (counts), the last column the size; want: splits x labels."""
    return place_many(labels, np.ones(len(labels), np.int64), want).argmax(axis=1)


def place_many(labels: np.ndarray, times: np.ndarray, want: np.ndarray) -> np.ndarray:
    """How many of the components of each label vector each split gets. labels as in place(), of times components each.

    The outstanding label that the fewest unplaced components have is taken first; its components, largest share first,
    each go to the split that wants most of it (then most rows, then the first).
    """
    want, out, open_rows = want.astype(float).copy(), np.zeros((len(labels), len(want)), np.int64), np.ones(len(labels), bool)
    has = labels[:, :-1] > 0
    left = (has * times[:, None]).sum(axis=0)

    def put(i: int, column: int) -> None:
        n, unit = int(times[i]), float(labels[i, column])
        if n > 1 and unit > 0:  # all but the last few at once: the wants are levelled
            w = np.sort(want[:, column])[::-1]
            levels = (np.cumsum(w) - n * unit) / np.arange(1, len(w) + 1)
            level = levels[np.flatnonzero(w > levels)[-1]]
            sure = np.maximum(np.floor((want[:, column] - level) / unit - 1e-9), 0).astype(np.int64)
            out[i] += sure
            want[:] -= sure[:, None] * labels[i][None, :]
            n -= int(sure.sum())
        for _ in range(n):
            s = max(range(len(want)), key=lambda s: (want[s, column], want[s, -1], -s))
            out[i, s] += 1
            want[s] -= labels[i]
        open_rows[i] = False

    while (open_ := np.flatnonzero(left)).size:
        label = open_[np.argmin(left[open_])]
        todo = np.flatnonzero(open_rows & has[:, label])
        for i in todo[np.argsort(-labels[todo, label], kind="stable")]:
            put(i, label)
            left -= has[i] * times[i]
    for i in np.flatnonzero(open_rows):
        put(i, -1)
    return settle(labels.astype(float), out, want)


def settle(labels: np.ndarray, out: np.ndarray, want: np.ndarray) -> np.ndarray:
    """out after moves of components between splits, and exchanges of two of the largest SWAPS classes, the best first,
    while they bring the outstanding wants nearer to 0.

    Rows weigh ROWS times as much as all labels together; each column is measured against its total.
    """
    total = np.maximum((labels * out.sum(axis=1)[:, None]).sum(axis=0), 1.0)
    weight = 1.0 / total**2
    weight[:-1] /= ROWS * max(len(total) - 1, 1)
    square = np.concatenate([(weight * labels[i : i + MAX_CLASSES] ** 2).sum(axis=1) for i in range(0, len(labels), MAX_CLASSES)] or [np.empty(0)])
    big = np.argsort(-labels[:, -1], kind="stable")[:SWAPS]
    apart = square[big][:, None] + square[big] - 2 * (labels[big] * weight) @ labels[big].T
    for _ in range(MOVES):
        best = (-1e-15, None)
        for a in range(len(want)):
            for b in range(len(want)):
                if a == b:
                    continue
                pull = np.concatenate([labels[i : i + MAX_CLASSES] @ (weight * (want[a] - want[b])) for i in range(0, len(labels), MAX_CLASSES)] or [np.empty(0)])
                n = np.clip(np.round(-pull / np.maximum(2 * square, 1e-300)), 0, out[:, a])
                gain = 2 * n * pull + 2 * n**2 * square
                i = int(gain.argmin()) if len(gain) else 0
                if len(gain) and gain[i] < best[0]:
                    best = (gain[i], [(a, b, i, int(n[i]))])
                if a < b and len(big):
                    gain = 2 * (pull[big][:, None] - pull[big]) + 2 * apart
                    gain[(out[big, a] == 0), :] = gain[:, out[big, b] == 0] = 0
                    i, j = np.unravel_index(int(gain.argmin()), gain.shape)
                    if gain[i, j] < best[0]:
                        best = (gain[i, j], [(a, b, big[i], 1), (b, a, big[j], 1)])
        if best[1] is None:
            break
        for a, b, i, n in best[1]:
            out[i, a] -= n
            out[i, b] += n
            want[a] += n * labels[i]
            want[b] -= n * labels[i]
    return out


def assign_splits(df: DataFrame, keys: dict[str, Column], label: Column, targets: list[tuple[str, float]]) -> DataFrame:
    """df with split_name: rows tied by any key land in one split, in proportions as near targets as the groups allow.

    label (NULL counts as a label) is what each split should hold its part of; more than MAX_LABELS labels raise
    ValueError; a split_name of df's own is replaced. A row without any key is a group of its own, with its exact copies. An empty table gives no rows.
    """
    df = df.drop("split_name")
    total_share = sum(t for _, t in targets)
    share = np.array([t / total_share for _, t in targets])
    names = [n for n, _ in targets]
    roots, anchor = tie_rows(df, keys)
    lone = F.concat(F.lit("row:"), F.sha2(F.to_json(F.struct("*")), 256))
    marked = df.withColumns({"_anchor": F.coalesce(anchor, lone), "_label": F.coalesce(label.cast("string"), F.lit("<none>"))})
    counts = marked.groupBy("_anchor", "_label").agg(F.count("*").alias("n"))
    counts = counts.join(roots, F.col("_anchor") == F.col("node"), "left").withColumn("component", F.coalesce("root", "_anchor"))
    counts = cut(counts.groupBy("component", "_label").agg(F.sum("n").alias("n")))
    rarest = counts.groupBy("_label").agg(F.sum("n").alias("n")).orderBy("n", "_label").limit(MAX_LABELS + 1).collect()
    if len(rarest) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    number = {r["_label"]: i for i, r in enumerate(rarest)}
    if not number:
        return df.withColumn("split_name", F.lit(None).cast("string"))
    of_label = F.create_map(*[F.lit(x) for kv in number.items() for x in kv])
    of = counts.withColumn("l", of_label[F.col("_label")])
    # a component has one entry a label
    vectors = of.groupBy("component").agg(F.array_sort(F.collect_list(F.struct("l", "n"))).alias("v"), F.sum("n").alias("size"))
    # equal vectors are one class, so that the driver gets as many classes as there are different ones
    vectors = cut(vectors.withColumn("c", F.xxhash64("v")))
    sums = vectors.select("c", F.explode("v").alias("e")).groupBy("c", "e.l").agg(F.sum("e.n").alias("n")).toArrow()
    sizes = vectors.groupBy("c").agg(F.count("*").alias("n"), F.avg("size").alias("size")).orderBy(F.desc("size"), "c").toArrow()
    classes, times = sizes.column("c").to_numpy(), sizes.column("n").to_numpy()
    by = np.argsort(classes)
    at = by[np.searchsorted(classes[by], sums.column("c").to_numpy())]
    v = np.zeros((len(classes), len(number) + 1))
    v[at, sums.column("l").to_numpy()] = sums.column("n").to_numpy()
    v /= times[:, None]
    v[:, -1] = v.sum(axis=1)
    got = place_many(v, times, share[:, None] * (v * times[:, None]).sum(axis=0)[None, :])
    ends = pa.array(np.cumsum(got, axis=1).tolist(), pa.list_(pa.int64()))
    places = df.sparkSession.createDataFrame(pa.table([pa.array(classes), ends], ["c", "_ends"]))
    # numbers of components within a class, by parts, as one class may have nearly all of them
    parted = vectors.select("component", "c").withColumn("_part", F.pmod(F.xxhash64("component"), F.lit(PARTS)))
    before = parted.groupBy("c", "_part").agg(F.count("*").alias("_n"))
    before = before.withColumn("_before", F.sum("_n").over(Window.partitionBy("c").orderBy("_part")) - F.col("_n")).drop("_n")
    rank = F.row_number().over(Window.partitionBy("c", "_part").orderBy("component")) - 1
    at_ = F.size(F.filter("_ends", lambda e: e <= F.col("_rank") + F.col("_before")))
    final = parted.withColumn("_rank", rank).join(before, ["c", "_part"]).join(F.broadcast(places), "c")
    final = final.select(F.col("component").alias("_component"), F.element_at(F.array(*map(F.lit, names)), at_ + 1).alias("split_name"))
    own = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    with_component = marked.join(own, F.col("_anchor") == F.col("_node"), "left").withColumn("_component", F.coalesce("_root", "_anchor")).drop("_node", "_root")
    # a component may hold a third of the rows
    spread = final.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = with_component.withColumn("_s", F.pmod(F.xxhash64(*[c for c, k in df.dtypes if not k.startswith(("map", "variant"))]), F.lit(SALTS)).cast("int"))
    return salted.join(spread, ["_component", "_s"], "left").drop("_component", "_s", "_anchor", "_label")
