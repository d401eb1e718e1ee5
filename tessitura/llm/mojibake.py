"""Text decoded with the wrong encoding: found and, where its bytes are all there, restored.

A smoothed character n-gram model is trained on the clean records: those that no encode-decode chain applies to, in any
script. Every candidate chain of a suspicious text is scored on the words that it changes; the likeliest is taken if it
beats the words as they stand by more than the margin in nats a character. The margin is validated on all clean records
and on what each encoding makes of them, each record by the model of those that its hash puts into the other half. Texts that hold a decoder's own sign of failure (U+FFFD, a
control character of the upper half) need no model.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessitura.llm import codepoints as cp
from tessitura.llm.charmap import MULTI, SINGLE, image, undo

BITS = 18
#: Nats a character by which a candidate must beat the text as it stands, where fewer than LEAST texts can say.
MARGIN, LEAST = 2.0, 20
#: Halves of the records, by hash; the margin's part of the way from 0 to the gains of nearly all garbled texts; steps of
#: a nat in which gains are counted, and nats on either side of 0.
FOLDS, BETWEEN, STEPS, SPAN = 2, 0.4, 4096, 32
#: Words whose forms a task remembers.
WORDS = 50_000

_VIET = "àáảãạăằắẳẵặâầấẩẫậđèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵ"
VIET = _VIET + _VIET.upper()
_QUIET = "“”‘’–—…♪ "


def _ranges(chars: str) -> str:
    """Characters as few ranges, which Java tests faster than single characters."""
    out, codes = "", sorted(set(map(ord, chars)))
    for c in codes:
        if c - 1 not in codes:
            end = c
            while end + 1 in codes:
                end += 1
            out += chr(c) + (f"-{chr(end)}" if end > c else "")
    return out


#: Pattern of texts that any chain can apply to: nearly every image of a UTF-8 sequence has a character beyond ASCII and
#: the Vietnamese letters, or a typographic sign right after a letter of the Latin-1 block; HIDDEN_PAIRS are the others.
_SHOWS = (
    rf"[^\x00-\x7F{_ranges(VIET + _QUIET)}]|[{_QUIET}](?<=[À-ÿ].)|[ÌÒÞ](?<=\p{{L}}.)|[ìòÌÒ](?<=[aeiouyâêôơưăýõãðAEIOUYÂÊÔÝÕÃÐ].)"
    r"|\?(?:\p{Ll}|\?|(?<=\p{L}.)\p{L}|(?<=^.|\s.)[\p{L}\s])"
)
_shows = regex.compile(_SHOWS)
HIDDEN_PAIRS = sorted({x for codec in SINGLE for c in VIET + _QUIET if len(x := image(c, codec)) == 2 and not _shows.search(x)})
SUSPICIOUS = "|".join([_SHOWS, *map(regex.escape, HIDDEN_PAIRS)])
_suspicious = regex.compile(SUSPICIOUS)
_hidden = np.array([ord(x[0]) << 16 | ord(x[1]) for x in HIDDEN_PAIRS], np.uint32)
_control = regex.compile("[\x80-\x84\x86-\x9f�]")
_han_run = regex.compile(r"[^\x00-\x7F]+")
_wide = regex.compile(r"[\u1100-\u11FF\u2E80-\uFFEF]")
_tone_image = regex.compile("[ÌÒÞìòýõð]")
_letters = np.frombuffer((_VIET + "aeiouy").encode("utf-32-le"), np.uint32).astype(np.uint64)
_lossy = regex.compile(r"\S*\?\S*")
_lost = regex.compile(r"\?\p{Ll}|^\?")


@functools.lru_cache(maxsize=1)
def _tables() -> dict[str, np.ndarray]:
    latin1 = cp.table("".join(map(chr, range(0xC0, 0x100))))
    return {
        "plain": cp.table("".join(map(chr, range(128))) + VIET + _QUIET),
        "quiet": cp.table(_QUIET),
        "latin1": latin1,
        "tone": cp.table("ÌÒÞ"),
        "mark": cp.table("ìòÌÒ"),
        "vowel": cp.table("aeiouyâêôơưăýõãðAEIOUYÂÊÔÝÕÃÐ"),
        "letter": cp.category("L"),
        "small": cp.category("Ll"),
        "space": cp.table(" \t\n\r\f\v"),
    }


def suspicious(u: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """What SUSPICIOUS says of each text, on the code points of a whole column."""
    t, n = _tables(), len(u)
    odd = ~cp.look(t["plain"], u)
    if n > 1:
        starts = np.zeros(n + 1, bool)
        starts[begin] = True
        inner = ~starts[1:n]  # the second of a pair belongs to the same text
        at = lambda name, part: cp.look(t[name], part)
        a, b = u[:-1], u[1:]
        first = np.flatnonzero(np.isin(a, _hidden >> 16) & inner)
        odd[first[np.isin(a[first] << 16 | np.minimum(b[first], 0xFFFF), _hidden)]] = True
        rare = np.flatnonzero((at("quiet", b) | at("mark", b) | at("tone", b)) & inner)
        x, y = a[rare], b[rare]
        bad = (at("quiet", y) & at("latin1", x)) | (at("tone", y) & at("letter", x)) | (at("mark", y) & at("vowel", x))
        odd[rare[bad] + 1] = True
        q = np.flatnonzero(u == ord("?"))
        if len(q):
            has_next, has_prev = ~starts[q + 1], ~starts[q]
            nxt, prv = u[np.minimum(q + 1, n - 1)], u[np.maximum(q - 1, 0)]
            open_ = ~has_prev | at("space", prv)
            lost = at("small", nxt) | (nxt == ord("?")) | (has_prev & at("letter", prv) & at("letter", nxt)) | (open_ & (at("letter", nxt) | at("space", nxt)))
            odd[q[lost & has_next]] = True
    return cp.any_in(odd, begin)


class Model:
    """Hashed character trigram, bigram and unigram counts; 2**BITS cells each, whatever the size of the corpus."""

    def __init__(self, counts: np.ndarray):
        self.c3, self.c2, self.c1 = (counts[k << BITS : (k + 1) << BITS] for k in range(3))
        self.total = max(float(self.c1.sum()), 1.0)

    def log_windows(self, u: np.ndarray) -> np.ndarray:
        """For rows of four characters, the log probability of the third and of the fourth if it is a letter."""
        k1 = u * np.uint64(0x9E3779B97F4A7C15)
        out = np.zeros(len(u))
        for j in (2, 3) if u[0, 3] != ord("?") else (2,):
            k2 = k1[:, j - 2] * np.uint64(0xC2B2AE3D27D4EB4F) + k1[:, j - 1]
            k3 = k2 * np.uint64(0xC2B2AE3D27D4EB4F) + k1[:, j]
            k2b = k1[:, j - 1] * np.uint64(0xC2B2AE3D27D4EB4F) + k1[:, j]
            p1 = (self.c1[_mix(k1[:, j])] + 0.02) / (self.total + 20.0)
            p2 = (self.c2[_mix(k2b)] + 4.0 * p1) / (self.c1[_mix(k1[:, j - 1])] + 4.0)
            out += np.log((self.c3[_mix(k3)] + 4.0 * p2) / (self.c2[_mix(k2)] + 4.0))
        return out

    def log_last(self, x: np.ndarray, y: np.ndarray, z: np.ndarray) -> np.ndarray:
        """Log probabilities of the characters z after x and y."""
        kx, ky, kz = (v.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for v in (x, y, z))
        k2 = kx * np.uint64(0xC2B2AE3D27D4EB4F) + ky
        p1 = (self.c1[_mix(kz)] + 0.02) / (self.total + 20.0)
        p2 = (self.c2[_mix(ky * np.uint64(0xC2B2AE3D27D4EB4F) + kz)] + 4.0 * p1) / (self.c1[_mix(ky)] + 4.0)
        return np.log((self.c3[_mix(k2 * np.uint64(0xC2B2AE3D27D4EB4F) + kz)] + 4.0 * p2) / (self.c2[_mix(k2)] + 4.0))

    def logp(self, texts: list[str]) -> np.ndarray:
        """Sums of the log probabilities of the characters of each text, all in one pass."""
        if not texts:
            return np.empty(0)
        padded = ["  " + t.lower() + " " for t in texts]
        size = np.array([len(t) for t in padded])
        i1, i2, i3 = grams("".join(padded))
        p1 = (self.c1[i1[2:]] + 0.02) / (self.total + 20.0)
        p2 = (self.c2[i2[1:]] + 4.0 * p1) / (self.c1[i1[1:-1]] + 4.0)
        p3 = np.log((self.c3[i3] + 4.0 * p2) / (self.c2[i2[:-1]] + 4.0))
        begin = np.cumsum(size) - size
        total = np.concatenate([[0.0], np.cumsum(p3)])
        return total[begin + size - 2] - total[begin]


def _mix(k: np.ndarray) -> np.ndarray:
    return ((k ^ (k >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BITS)).astype(np.int64)


def grams(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of the characters, pairs and triples of a lower-cased text."""
    u = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    k1 = u * np.uint64(0x9E3779B97F4A7C15)
    k2 = k1[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + k1[1:]
    k3 = k2[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + k1[2:]
    return _mix(k1), _mix(k2), _mix(k3)


def count_grams(texts: list[str]) -> np.ndarray:
    """Counts of all cells, trigrams first; a text counts the same whatever texts it comes with."""
    out = np.zeros(3 << BITS, np.int64)
    for i in range(0, len(texts), 4000):
        i1, i2, i3 = grams("  " + "  ".join(texts[i : i + 4000]).lower() + "  ")
        for k, x in ((0, i3), (1, i2[1:]), (2, i1[2:])):
            out[k << BITS : (k + 1) << BITS] += np.bincount(x, minlength=1 << BITS)
    return out


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list[str]]]:
    """The clean texts of each batch of texts and halves, by half: what isn't suspicious, then what no chain applies to."""
    known: dict[str, bool] = {}
    for b in batches:
        b = b.filter(b.column(0).is_valid())
        fold = b.column(1).to_numpy(zero_copy_only=False)
        odd = suspicious(*cp.points(b.column(0)))
        out = [b.column(0).filter(pa.array(~odd & (fold == f))).to_pylist() for f in range(FOLDS)]
        for t, f in zip(b.column(0).filter(pa.array(odd)).to_pylist(), fold[odd].tolist()):
            if (clean := known.get(t)) is None:
                clean = known[t] = not (_control.search(t) or _lossy.search(t) or candidates(t))
            if clean:
                out[f].append(t)
        if len(known) > 100_000:
            known.clear()
        yield out


def train_folds(df: DataFrame, text: str) -> np.ndarray:
    """Counts over all clean records of df, by half; only the cells (at most FOLDS * 3 * 2**BITS) come to the driver."""
    size = 3 << BITS

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FOLDS * size, np.int64)
        for texts in _halves(batches):
            for f in range(FOLDS):
                total[f * size : (f + 1) * size] += count_grams(texts[f])
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(total[at])], ["cell", "n"])

    rows = df.select(F.col(text).alias("t"), _fold("t").alias("fold"))
    rows = rows.mapInArrow(part, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(FOLDS * size, np.int64)
    out[rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
    return out.reshape(FOLDS, size)


def _fold(text: str):
    return F.pmod(F.xxhash64(text), F.lit(FOLDS)).cast("int")


def train(df: DataFrame, text: str) -> np.ndarray:
    """Counts over all clean records of df."""
    return train_folds(df, text).sum(axis=0)


class _Image(dict):
    """What an encoding makes of the UTF-8 bytes of a character, for str.translate."""

    def __init__(self, codec: str):
        self.codec = codec

    def __missing__(self, c: int) -> str:
        out = self[c] = image(chr(c), self.codec) if c > 127 else chr(c)
        return out


class Gains:
    """What undoing each single-byte encoding gains on texts that it garbled, in nats a character of the words beyond
    ASCII, which are those that it changes.

    A text's log probability is the sum of its words' own ones and of their first characters after the word before, so
    that each distinct word is looked at once in each form: as it is, and as every encoding makes it.
    """

    def __init__(self, model: Model):
        self.model, self.images = model, [None, *map(_Image, SINGLE)]
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.inner, self.size, self.first, self.last = (np.empty((len(self.images), 0)) for _ in range(4))

    def _learn(self, words: list[str]) -> None:
        cols = []
        for of in self.images:
            s = " " + "  ".join(words) + " "
            s = (s.translate(of) if of is not None else s).lower()
            u = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)
            ink = u != 32
            begin, end = np.flatnonzero(ink[1:] & ~ink[:-1]) + 1, np.flatnonzero(ink[:-1] & ~ink[1:]) + 1
            total = np.concatenate([[0.0], np.cumsum(self.model.log_last(u[:-2], u[1:-1], u[2:]))])
            cols.append((total[end - 1] - total[begin - 1], end - begin, u[begin], u[end - 1]))
        for name, new in zip(("inner", "size", "first", "last"), zip(*cols)):
            setattr(self, name, np.concatenate([getattr(self, name), np.array(new, float)], axis=1))

    def of(self, texts: list[str]) -> np.ndarray:
        """Encodings x texts; texts without a word beyond ASCII are left out."""
        if len(self.known) > WORDS:
            self.clear()
        said = [w for t in texts if (w := [x for x in t.split(" ") if not x.isascii()])]
        if not said:
            return np.empty((len(self.images) - 1, 0))
        if new := [w for w in dict.fromkeys(w for ws in said for w in ws) if w not in self.known]:
            self._learn(new)
            self.known |= zip(new, range(len(self.known), len(self.known) + len(new)))
        ids = np.array([self.known[w] for ws in said for w in ws])
        n = np.array([len(ws) for ws in said])
        begin = np.cumsum(n) - n
        before = np.concatenate([[-1], ids[:-1]])
        before[begin] = -1
        pairs, where = np.unique((before + 1) << 32 | ids, return_inverse=True)
        word, prev = pairs & 0xFFFFFFFF, (pairs >> 32) - 1
        space = np.full(len(pairs), 32)
        each = []
        for k in range(len(self.images)):
            after = np.where(prev < 0, 32, self.last[k, prev])
            p = self.inner[k, word] + self.model.log_last(after, space, self.first[k, word])
            each.append(np.add.reduceat(p[where], begin) / np.add.reduceat(self.size[k, ids] + 1, begin))
        return each[0] - np.array(each[1:])

    def counts(self, texts: list[str]) -> np.ndarray:
        """How many gains there are of each step."""
        step = np.clip(np.floor(self.of(texts) * STEPS), -SPAN * STEPS, SPAN * STEPS - 1).astype(np.int64) + SPAN * STEPS
        return np.bincount(step.ravel(), minlength=2 * SPAN * STEPS)


def margin_of(gained: np.ndarray) -> float:
    """The margin between 0 and all gains but one in a thousand, given how many there are of each step. No chain applies to
    a clean text, so what it gains as it stands is 0."""
    if gained.sum() < LEAST * len(SINGLE):
        return MARGIN
    high = (int(np.searchsorted(np.cumsum(gained), 0.001 * gained.sum())) - SPAN * STEPS) / STEPS
    return BETWEEN * high if high > 0 else MARGIN


def fit_margin(counts: np.ndarray, held: list[str]) -> float:
    """The margin by clean texts that the model's counts don't hold; MARGIN where fewer than LEAST are given."""
    return margin_of(Gains(Model(counts)).counts(held))


def gained(df: DataFrame, text: str, folds: np.ndarray) -> np.ndarray:
    """How many gains there are of each step on all clean records of df, each by the other half's model."""
    sent = df.sparkSession.sparkContext.broadcast(folds)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = [Gains(Model(sent.value.sum(axis=0) - sent.value[f])) for f in range(FOLDS)]
        total = np.zeros(2 * SPAN * STEPS, np.int64)
        for texts in _halves(batches):
            for f in range(FOLDS):
                total += of[f].counts(texts[f])
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(total[at])], ["step", "n"])

    rows = df.select(F.col(text).alias("t"), _fold("t").alias("fold"))
    rows = rows.mapInArrow(part, "step int, n bigint").groupBy("step").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(2 * SPAN * STEPS, np.int64)
    out[rows.column("step").to_numpy()] = rows.column("n").to_numpy()
    return out


def fit(df: DataFrame, text: str) -> tuple[np.ndarray, float]:
    """(counts, margin) of the model of df's texts: counts over all clean ones, the margin by all of them too."""
    folds = train_folds(df, text)
    return folds.sum(axis=0), margin_of(gained(df, text, folds))


def from_cp1258(text: str) -> str:
    """The chain cp1252 → cp1258 word by word; tone marks join the vowel before them."""

    def word(m: regex.Match) -> str:
        w = m.group()
        try:
            return unicodedata.normalize("NFC", w.encode("cp1252").decode("cp1258"))
        except (UnicodeEncodeError, UnicodeDecodeError):
            return w

    return regex.sub(r"\S+", word, text)


def from_multi(text: str, codec: str) -> str:
    """Runs beyond ASCII whose bytes in a multi-byte encoding are UTF-8 of fewer, other letters."""

    def run(m: regex.Match) -> str:
        s = m.group()
        try:
            back = s.encode(codec).decode("utf-8")
        except UnicodeError:
            return s
        return back

    return _han_run.sub(run, text)


def candidates(text: str) -> list[str]:
    """Different results of all chains; chains through UTF-8 are tried twice over, for text that was garbled twice."""
    out: dict[str, None] = {}
    for codec in SINGLE:
        out[undo(text, codec)] = None
    out.pop(text, None)
    once = min(out, key=len, default="")  # the chain that undid most
    if once and _suspicious.search(once):
        for codec in SINGLE:
            out[undo(once, codec)] = None
    if _wide.search(text):
        for codec in MULTI:
            out[from_multi(text, codec)] = None
    if _tone_image.search(text):
        out[from_cp1258(text)] = None
    out.pop(text, None)
    return list(out)


def changed(text: str, other: str) -> tuple[str, str]:
    """The words in which the two texts differ, where they have as many words; else both texts."""
    a, b = text.split(" "), other.split(" ")
    if len(a) != len(b):
        return text, other
    k = [i for i in range(len(a)) if a[i] != b[i]]
    return " ".join(a[i] for i in k), " ".join(b[i] for i in k)


def fill(model: Model, word: str) -> str:
    """A likely word when each ? in it stands for one letter: from the left, the letter that fits both neighbours best."""
    u = np.frombuffer(("  " + word + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    u = np.concatenate([u, [np.uint64(32)]])
    for i in np.flatnonzero(u == ord("?")):
        trial = np.tile(u[i - 2 : i + 2], (len(_letters), 1))
        trial[:, 2] = _letters
        u = u.copy()
        u[i] = _letters[int(np.argmax(model.log_windows(trial)))]
    return u[2:-2].astype(np.uint32).tobytes().decode("utf-32-le")


def lossy(model: Model, text: str, margin: float = MARGIN) -> bool:
    """Whether question marks in text stand for lost letters."""
    hard = [w for w in (m.group() for m in _lossy.finditer(text)) if _lost.search(w)]
    if not hard:
        return False
    x = " ".join(hard)
    y = " ".join(fill(model, w.lower()) for w in hard)
    before, after = model.logp([x, y])
    return after / (len(y) + 1) - before / (len(x) + 1) > margin


def repair(model: Model, texts: list[str], margin: float = MARGIN) -> list[tuple[bool, str | None]]:
    """(affected, restored text or NULL where it can't be recovered) of each text; candidates are scored together."""
    chains = [candidates(t) if _suspicious.search(t) else None for t in texts]
    flat = [(i, other, *changed(texts[i], other)) for i, c in enumerate(chains) if c for other in c]
    scores = model.logp([s for f in flat for s in f[1:]]).reshape(-1, 3)
    best: dict[int, tuple[float, str]] = {}
    for (i, other, x, y), (whole, before, after) in zip(flat, scores):
        if after / (len(y) + 1) - before / (len(x) + 1) > margin and (i not in best or whole > best[i][0]):
            best[i] = (whole, other)
    out: list[tuple[bool, str | None]] = []
    for i, t in enumerate(texts):
        if i in best:
            out.append((True, None if _control.search(best[i][1]) else best[i][1]))
        else:
            out.append((chains[i] is not None and bool(_control.search(t) or lossy(model, t, margin)), None))
    return out


def repairer(counts: np.ndarray, margin: float = MARGIN):
    """A function of a list of texts → (affected, restored), once a distinct text."""
    model = Model(counts)

    def many(texts: list[str | None]) -> tuple[list[bool], list[str | None]]:
        distinct = list({t for t in texts if t})
        done = dict(zip(distinct, repair(model, distinct, margin)))
        both = [done.get(t, (False, None)) for t in texts]
        return [a for a, _ in both], [b for _, b in both]

    return many


def find_garbled(df: DataFrame, key: str, text: str, fitted: tuple[np.ndarray, float] | None = None) -> DataFrame:
    """Affected rows (key, text, restored); restored is NULL where bytes were lost.

    NULL and empty texts are never affected; equal texts are scored once a batch, each stored row is listed; an empty
    table gives no rows; other columns are ignored. Texts are scored whole, whatever their length.
    """
    sent = df.sparkSession.sparkContext.broadcast(fitted or fit(df, text))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = repairer(*sent.value)
        for b in batches:
            b = b.filter(pa.array(suspicious(*cp.points(b.column(1)))))
            bad, fixed = many(b.column(1).to_pylist())
            out = pa.record_batch([b.column(0), b.column(1), pa.array(fixed, pa.string())], ["k", "t", "restored"])
            yield out.filter(pa.array(bad, pa.bool_()))

    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    out = rows.mapInArrow(part, f"k {dict(rows.dtypes)['k']}, t string, restored string")
    return out.select(F.col("k").alias(key), F.col("t").alias(text), "restored")


def validate(clean: list[str], counts: np.ndarray) -> dict[str, float]:
    """On held-out clean texts: the share of them flagged, and of their garbled forms the share found and restored."""
    many = repairer(counts)
    flagged = sum(many(clean)[0])
    made, truth = [], []
    for t in clean:
        if not any(ord(c) > 127 for c in t):
            continue
        for codec in ("latin-1", "cp1258", "mac_roman", "cp437", "cp1251", "gb18030"):
            try:
                bad = t.encode("utf-8").decode(codec)
            except UnicodeDecodeError:
                continue
            made.append(bad)
            truth.append(t)
    bad, fixed = many(made)
    n = max(len(made), 1)
    return {"false": flagged / max(len(clean), 1), "found": sum(bad) / n, "restored": sum(f == t for f, t in zip(fixed, truth)) / n}
