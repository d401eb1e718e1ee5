"""Evaluation passages inside documents: SimHash of item-sized windows, Hamming blocks, exact verification.

Words are read from whole Arrow columns of code points: case, accents, punctuation, caption timing and markup go, each
word becomes a 64-bit hash. Windows of WINDOW words (a part of an item) and windows as long as the item (its class of
sizes) give 64-bit SimHashes. Fingerprints within RADIUS share at least one of RADIUS + 1 blocks of bits, so looking
all blocks up finds every pair within the radius; windows of equal words are at distance 0. Candidates are verified
exactly on the alignment that they propose: the longest run of equal words, and the weighted five-word shingles of the
item-long stretch of the document. What reaches the similarity SIMILAR keeps a run of WINDOW equal words whenever the
item has WINDOW + 1 words or more, so no such stretch is missed.

The items are the query set: they go out in blocks of at most BLOCK_WORDS words (or one longer item), each against all
documents; executors index a block, the driver holds the hashes of one block at a time. With several blocks the
documents' hashes are written once and read for each block.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessitura.llm import codepoints as cp
from tessitura.runtime import cut

WINDOW, RADIUS, SHINGLE, SIMILAR = 12, 3, 5, 0.8
#: Words of the items of a block: 8 bytes each go to every executor.
BLOCK_WORDS = 500_000
#: Words hashed at a time; bounds a task's memory whatever the length of a text.
CHUNK = 16_384
#: Sizes of windows: an item's class is the largest that it fills.
SIZES = [WINDOW]
while SIZES[-1] < 10_000_000:
    SIZES.append(SIZES[-1] * 3 // 2)

_timing = regex.compile(r"(?m)^(?:\d+[^\S\n]*\r?\n)?[^\S\n]*(?:\d{1,2}:)?\d{1,2}:\d{2}[.,]\d{1,3}\s*-->[^\n]*$|\b\d{1,2}:\d{2}:\d{2}(?:[.,]\d+)?\b|\[\d{1,2}:\d{2}(?:[.,]\d+)?\]")
_tag = regex.compile(r"<[^<>\n]*>|\{\\[^{}]*\}")
_MAY_STRIP = r"-->|\d:\d\d|<|\{\\"
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _base(c: str) -> str:
    """A character without case and accents."""
    folded = "".join(x for x in unicodedata.normalize("NFKD", c.casefold()) if not unicodedata.category(x).startswith("M"))
    return unicodedata.normalize("NFC", folded.casefold()).replace("đ", "d")


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the basic plane: the letter or digit a character counts as (0 if none), marks, ideographs and kana, and
    characters that count as several."""
    letter, mark, single, several = np.zeros(cp.PLANE, np.uint32), cp.category("M"), np.zeros(cp.PLANE, bool), np.zeros(cp.PLANE, bool)
    for i in range(cp.PLANE):
        c = chr(i)
        if mark[i] or 0xD800 <= i < 0xE000:
            continue
        b = _base(c) if i > 127 else c.lower()
        own = regex.match(r"[\p{L}\p{N}]", c) is not None
        if len(b) == 1 and (regex.match(r"[\p{L}\p{N}]", b) or own):
            letter[i] = ord(b)
        elif len(b) > 1 and regex.search(r"[\p{L}\p{N}]", b):
            several[i] = True
        several[i] |= 0x1100 <= i < 0x1200  # jamo compose with what follows
        single[i] = regex.match(r"[\p{Han}\p{Hiragana}\p{Katakana}]", c) is not None
    return letter, mark, single, several


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words of all texts, where each text's begin, and the end); NULL has none. Ideographs and kana
    count one word each."""
    letter, mark, single, several = _tables()
    column = column.fill_null("").cast(pa.large_string())
    odd = pc.match_substring_regex(column, _MAY_STRIP)
    if pc.any(odd).as_py():
        texts = [_tag.sub("", _timing.sub(" ", t)) for t in column.filter(odd).to_pylist()]
        column = pc.replace_with_mask(column, odd, pa.array(texts, pa.large_string()))
    u, begin = cp.points(column)
    if len(u) and (cp.look(several, u) | (u >= cp.PLANE)).any():
        bad = cp.any_in(cp.look(several, u, True), begin)
        texts = ["".join(_base(c) if ord(c) >= cp.PLANE or several[ord(c)] else c for c in unicodedata.normalize("NFC", t)) for t in column.filter(pa.array(bad)).to_pylist()]
        u, begin = cp.points(pc.replace_with_mask(column, pa.array(bad), pa.array(texts, pa.large_string())))
    keep = ~cp.look(mark, u)
    begin = np.concatenate([[0], np.cumsum(keep)])[begin]
    u = u[keep]
    base = letter[np.minimum(u, cp.PLANE - 1)]
    base = np.where(u >= cp.PLANE, u, base) if len(u) and u.max() >= cp.PLANE else base
    word, one = base > 0, cp.look(single, u)
    fresh = np.ones(len(u), bool)
    if len(u) > 1:
        fresh[1:] = ~word[:-1] | one[1:] | one[:-1]
    fresh[begin[:-1][begin[:-1] < len(u)]] = True
    first = np.flatnonzero(word & fresh)
    if not len(first):
        return np.empty(0, np.uint64), np.zeros(len(begin), np.int64)
    at = np.flatnonzero(word)
    place = at - first[np.searchsorted(first, at, "right") - 1]  # of the letter in its word
    h = (base[at].astype(np.uint64) + np.uint64(1)) * _K[0] + place.astype(np.uint64) * _K[1]
    h = (h ^ (h >> np.uint64(29))) * _K[2]
    h = np.add.reduceat((h ^ (h >> np.uint64(32))) * _K[3], np.searchsorted(at, first))
    h = (h ^ (h >> np.uint64(31))) * _K[2]
    return h ^ (h >> np.uint64(27)), np.searchsorted(first, begin)


def hashes(text: str | None) -> np.ndarray:
    """Hashes of the words of one text."""
    return hashed_words(pa.array([text], pa.string()))[0]


def fingerprints(h: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """SimHash of each run of ``window`` hashes, in order."""
    n = len(h) - window + 1
    if n < 1:
        return np.empty(0, np.uint64)
    out = np.empty(n, np.uint64)
    wide = np.int16 if window < 16_384 else np.int32
    for i in range(0, n, CHUNK):
        part = h[i : min(i + CHUNK, n) + window - 1]
        set_ = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        # sums may wrap: only differences a window apart are used
        total = np.zeros((len(part) + 1, 64), wide)
        np.cumsum(set_, axis=0, dtype=wide, out=total[1:])
        votes = total[window:] - total[:-window]
        packed = np.packbits(votes * 2 >= window, axis=1, bitorder="little")
        out[i : i + len(packed)] = packed.view(np.uint64).ravel()
    return out


class Prints:
    """Fingerprints of items' windows of one size, by each block of their bits."""

    BITS = 64 // (RADIUS + 1)

    def __init__(self, prints: np.ndarray, where: np.ndarray):
        self.prints, self.where, self.blocks = prints, where, []
        for k in range(RADIUS + 1):
            key = self.block(prints, k)
            first = np.zeros((1 << self.BITS) + 1, np.int64)
            np.cumsum(np.bincount(key, minlength=1 << self.BITS), out=first[1:])
            self.blocks.append((first, np.argsort(key, kind="stable")))

    @classmethod
    def block(cls, prints: np.ndarray, k: int) -> np.ndarray:
        return ((prints >> np.uint64(k * cls.BITS)) & np.uint64((1 << cls.BITS) - 1)).astype(np.int64)

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (position in prints, position in these) within RADIUS, once each."""
        found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        mine = [self.block(prints, k) for k in range(RADIUS + 1)]
        theirs = [self.block(self.prints, k) for k in range(RADIUS + 1)]
        for k, (first, order) in enumerate(self.blocks):
            n = first[mine[k] + 1] - first[mine[k]]
            hit = np.flatnonzero(n)
            # in portions, so that a block that many windows share can't fill the memory
            step = max(1, int(4_000_000 // max(1, n.max(initial=1))))
            for i in range(0, len(hit), step):
                h = hit[i : i + step]
                a = np.repeat(h, n[h])
                b = order[np.arange(n[h].sum()) - np.repeat(np.cumsum(n[h]) - n[h], n[h]) + np.repeat(first[mine[k][h]], n[h])]
                close = np.bitwise_count(prints[a] ^ self.prints[b]) <= RADIUS
                a, b = a[close], b[close]
                for j in range(k):  # found by an earlier block already
                    new = mine[j][a] != theirs[j][b]
                    a, b = a[new], b[new]
                found_a.append(a)
                found_b.append(b)
        return np.concatenate(found_a), np.concatenate(found_b)


class Index:
    """Items' words, and the windows of each size: all of WINDOW words, and the first and last of an item's own class."""

    def __init__(self, words: np.ndarray, begins: np.ndarray):
        self.words, self.begins = words, begins
        size = np.diff(begins)
        self.sizes: dict[int, Prints] = {}
        kind = np.searchsorted(SIZES, size, "right") - 1
        for k in np.unique(kind[kind >= 0]).tolist() + [0] * bool((kind >= 0).any()):
            w = SIZES[k]
            mine = np.flatnonzero(kind >= 0) if k == 0 else np.flatnonzero(kind == k)
            at = [np.arange(begins[i], begins[i + 1] - w + 1) for i in mine] if k == 0 else [np.unique([begins[i], begins[i + 1] - w]) for i in mine]
            prints = [fingerprints(words[begins[i] : begins[i + 1]], w)[x - begins[i]] for i, x in zip(mine, at)]
            self.sizes[w] = Prints(np.concatenate(prints), np.concatenate(at))


def shingle_similarity(a: np.ndarray, b: np.ndarray, size: int = SHINGLE) -> float:
    """Weighted Jaccard similarity of two word sequences' shingles (the weight is how often a shingle occurs)."""
    count = lambda x: np.unique(np.lib.stride_tricks.sliding_window_view(x, min(size, len(x))), axis=0, return_counts=True)
    (ka, na), (kb, nb) = count(a), count(b)
    da, db = ({k.tobytes(): int(n) for k, n in zip(ks, ns)} for ks, ns in ((ka, na), (kb, nb)))
    low = sum(min(n, db.get(k, 0)) for k, n in da.items())
    return low / (na.sum() + nb.sum() - low)


def leaks_of(index: Index, flat: np.ndarray, begin: np.ndarray) -> list[tuple[int, int, int, float, int]]:
    """(text, item, n_windows, similarity, longest run of equal words from WINDOW up, else 0) of the leaks in hashed texts."""
    owner = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    found = []
    for w, prints in index.sizes.items():
        n = len(flat) - w + 1
        if n < 1:
            continue
        inside = np.flatnonzero(owner[:n] == owner[w - 1 :])
        a, b = prints.near(fingerprints(flat, w)[inside])
        a, y = inside[a], prints.where[b]
        if w == WINDOW:
            same = np.ones(len(a), bool)
            for j in range(WINDOW):
                same &= flat[a + j] == index.words[y + j]
        else:
            same = np.zeros(len(a), bool)
        found.append((a, y, same))
    if not found:
        return []
    a, y, same = (np.concatenate(x) for x in zip(*found))
    if not len(a):
        return []
    item, doc = np.searchsorted(index.begins, y, "right") - 1, owner[a]
    shift = y - a
    order = np.lexsort((~same, a, shift, item, doc))
    a, y, same, item, doc, shift = (x[order] for x in (a, y, same, item, doc, shift))
    again = np.concatenate([[False], (a[1:] == a[:-1]) & (shift[1:] == shift[:-1]) & (item[1:] == item[:-1])])
    a, y, same, item, doc, shift = (x[~again] for x in (a, y, same, item, doc, shift))
    on = np.concatenate([[False], same[1:] & same[:-1] & (a[1:] == a[:-1] + 1) & (shift[1:] == shift[:-1]) & (item[1:] == item[:-1]) & (doc[1:] == doc[:-1])])
    head = np.maximum.accumulate(np.where(on, 0, np.arange(len(a))))
    run = np.where(same, WINDOW + np.arange(len(a)) - head, 0)
    # one alignment a document, item and shift
    new = np.flatnonzero(np.concatenate([[True], (shift[1:] != shift[:-1]) | (item[1:] != item[:-1]) | (doc[1:] != doc[:-1])]))
    runs, counts = np.maximum.reduceat(run, new), np.add.reduceat(same.astype(np.int64), new)
    out: dict[tuple[int, int], list] = {}
    for k, r, n in zip(new.tolist(), runs.tolist(), counts.tolist()):
        d, i = int(doc[k]), int(item[k])
        lo, hi = int(index.begins[i]), int(index.begins[i + 1])
        stretch = flat[max(int(begin[d]), lo - int(shift[k])) : min(int(begin[d + 1]), hi - int(shift[k]))]
        similar = 1.0 if r == hi - lo else shingle_similarity(stretch, index.words[lo:hi])
        if r or similar >= SIMILAR:
            got = out.setdefault((d, i), [0, 0.0, 0])
            got[0] += n
            got[1] = max(got[1], similar)
            got[2] = max(got[2], r)
    return [(d, i, *v) for (d, i), v in out.items()]


def _hashed(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, h): the words' hashes of each text of WINDOW words or more."""
    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t")).filter(F.col("t").isNotNull())

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, begin = hashed_words(b.column(1))
            lists = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(h.view(np.int64)))
            yield pa.record_batch([b.column(0), lists], ["k", "h"]).filter(pa.array(np.diff(begin) >= WINDOW))

    return rows.mapInArrow(part, f"k {dict(rows.dtypes)['k']}, h array<bigint>")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and begins of a list column."""
    begin = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False).view(np.uint64)[begin[0] : begin[-1]], begin - begin[0]


def find_leaks(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """(doc_id, item_id, n_windows, similarity, longest_run) of every document that holds a passage of an item.

    A passage is a run of WINDOW or more of the item's words (longest_run, else 0), or a stretch as long as the item
    whose shingles have the similarity SIMILAR or more; similarity is that of the best such stretch. NULL, empty and
    texts of fewer than WINDOW words match nothing; repeated rows are each reported; an empty table gives no rows;
    other columns are ignored.
    """
    spark = docs.sparkSession
    queries = cut(_hashed(items, item_id, item_text).withColumn("n", F.size("h")))
    parts = max(1, int(queries.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]) // (BLOCK_WORDS * 8))
    within = F.sum("n").over(Window.partitionBy("p").orderBy("k", "n").rowsBetween(Window.unboundedPreceding, -1))
    queries = queries.withColumn("p", F.pmod(F.xxhash64("k"), F.lit(parts))).withColumn("s", F.floor(F.coalesce(within, F.lit(0)) / BLOCK_WORDS))
    blocks = [tuple(r) for r in queries.select("p", "s").distinct().orderBy("p", "s").collect()] or [(0, 0)]
    kinds = f"d {dict(docs.dtypes)[doc_id]}, i {dict(items.dtypes)[item_id]}, n_windows int, similarity double, longest_run int"
    many = len(blocks) > 1
    if many:
        queries = cut(queries)
        corpus = cut(_hashed(docs, doc_id, text))
    else:
        corpus = docs.select(F.col(doc_id).alias("k"), F.col(text).alias("t")).filter(F.col("t").isNotNull())
    out = None
    for p, s in blocks:
        block = queries.filter((F.col("p") == p) & (F.col("s") == s)).select("k", "h").toArrow().combine_chunks()
        h = block.column("h").combine_chunks() if block.num_rows else pa.array([], pa.list_(pa.int64()))
        sent = spark.sparkContext.broadcast((block.column("k").combine_chunks() if block.num_rows else None, *_flat(h)))

        def part(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, words, begins = sent.value
            if ids is None:
                return
            index = Index(words, begins)
            for batch in batches:
                for lo in range(0, batch.num_rows, 2048):
                    b = batch.slice(lo, 2048)
                    rows = leaks_of(index, *(_flat(b.column(1)) if pa.types.is_list(b.column(1).type) else hashed_words(b.column(1))))
                    if rows:
                        d, i, n, sim, r = zip(*rows)
                        yield pa.record_batch([b.column(0).take(pa.array(d, pa.int64())), ids.take(pa.array(i, pa.int64())), pa.array(n, pa.int32()), pa.array(sim, pa.float64()), pa.array(r, pa.int32())], ["d", "i", "n_windows", "similarity", "longest_run"])

        found = corpus.mapInArrow(part, kinds)
        if many:
            found = cut(found)
            sent.destroy()
        out = found if out is None else out.unionByName(found)
    return out.select(F.col("d").alias(doc_id), F.col("i").alias(item_id), "n_windows", "similarity", "longest_run")
