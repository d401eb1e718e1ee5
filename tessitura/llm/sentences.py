"""Sentence boundaries across languages and scripts by cascading break and no-break rules.

A rule is a pair of patterns, for what stands before and after a position, with a verdict. At every candidate position
the tables of the text's language and scripts are asked in order, the most particular first; the first rule whose two
patterns match decides. A position is a candidate after a sentence mark with its closing marks, at an empty line, and in
Thai at a space. A language's own table of abbreviations is asked first; the other languages' follow, as texts quote
each other, but Vietnamese ones not in English texts without Vietnamese letters. Rules see the whole text. One of them,
INSIDE, asks not a pattern but the pairs of brackets and quotation marks around the position, which patterns can't nest.
"""

from __future__ import annotations

import bisect
import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessitura.llm import codepoints as cp
from tessitura.llm.mojibake import suspicious

MARKS = r".!?…‥。．！？｡।॥؟۔‼⁇⁈⁉"
CLOSERS = r"\"'”’»›」』）)\]}】》〉♪"
# Abbreviations, in natural order, without their last full stop.
#: Titles, names of places and numbers: what follows belongs to them.
LEADING = {
    "vi": "TS ThS GS PGS KS BS CN CH LS DS NSƯT NSND TP Tp P Q H TX TT Ng tr Tr đ Đ st ĐT".split(),
    "en": "Dr Mr Mrs Ms Prof Rev Hon St Sr Jr Gen Col Capt Lt Sgt Sen Rep Gov vs cf e.g i.e viz Mt".split(),
    "hi": "डॉ श्री श्रीमती प्रो पं सं".split(),
}
#: Before a number only; elsewhere they are words like others.
NUMBERED = {"vi": "tr số".split(), "en": "No Nos Vol Fig p pp approx ca Ch Sec".split(), "hi": "सं".split()}
#: These may also close a sentence, before a capital.
CLOSING = {"vi": "v.v vv".split(), "en": "p.m a.m etc Inc Ltd Co Corp".split()}
#: Hesitations; with dots after them the sentence goes on.
HESITATION = "à ờ ừm ừ ơ hừm er erm uh um hmm hm well oh ah".split()


@dataclass(frozen=True)
class Rule:
    """before must match up to the position, after from it; ends says whether the position ends a sentence. apart: what
    before matches doesn't follow a full stop of its own sentence."""

    before: regex.Pattern
    after: regex.Pattern
    ends: bool
    apart: bool = False


def _rule(before: str, after: str, ends: bool, apart: bool = False) -> Rule:
    return Rule(regex.compile(f"(?r)(?:{before})"), regex.compile(after), ends, apart)


def _words(*lists: list[str]) -> str:
    return "|".join(regex.escape(w) for ws in lists for w in sorted(ws, key=len, reverse=True))


_C = rf"[{CLOSERS}]*"
_opening = r"[\"'“‘«‹「『（(\[{【《〈¿¡♪-]*"
#: Every table is a list of rules; a cascade is a list of tables.
EVERYWHERE = [
    _rule(r"\s", r"", False),  # a position stands before the white space, never after it
    _rule(r"[^\S\n]*", r"[^\S\n]*(?:\r?\n[^\S\n]*){2,}\S", True),  # an empty line
    _rule(r"", r"[^\p{L}\p{N}]*$", False),  # no sentence follows; the text's own end isn't listed
    _rule(rf"[{MARKS}]", rf"[{MARKS}{CLOSERS}]", False),  # the marks go on
    _rule(rf"[{MARKS}]{_C}", r"\s*[,;:，；：、]", False),
    _rule(rf"[{MARKS}]{_C}", r"\s*[–—]", False),  # a dash carries on the sentence
]
def _abbreviations(lang: str) -> list[Rule]:
    return [
        _rule(rf"(?<![\p{{L}}\p{{M}}\p{{N}}])(?:{_words(LEADING[lang])})\.", r"", False, apart=True),
        _rule(rf"(?<![\p{{L}}\p{{M}}\p{{N}}])(?i:{_words(NUMBERED[lang])})\.", r"\s*[\p{N}#]", False, apart=True),
    ]


LATIN = {
    "vi": _abbreviations("vi"),
    "en": _abbreviations("en"),
    "": [
        _rule(r"(?<![\p{L}\p{M}\p{N}])\p{Lu}\.", r"\s*(?:\p{Lu}\.|\p{Lu})", False, apart=True),  # an initial
        _rule(rf"(?i:(?<![\p{{L}}\p{{M}}])(?:{_words(HESITATION)}))(?:\.\.+|…)", r"", False),
        _rule(r"[.…]", r"[\p{Ll}\p{M}\p{N}_]", False),  # inside a number, a name of a file, an address
        _rule(rf"(?<![\p{{L}}\p{{M}}\p{{N}}])(?:{_words(*CLOSING.values())})\.{_C}", rf"\s+{_opening}(?=\p{{Lu}})", True),
        _rule(rf"[.!?…‼⁇⁈⁉]{_C}", rf"\s*{_opening}\p{{Ll}}", False),  # the same sentence goes on in small letters
        _rule(r"\p{L}\.\p{L}+\.", r"\S", False),
        _rule(rf"[.!?…‼⁇⁈⁉]{_C}", rf"\s+{_opening}[\p{{L}}\p{{N}}]", True),
        _rule(rf"[.!?…‼⁇⁈⁉]{_C}", rf"{_opening}[\p{{Lu}}\p{{Lt}}\p{{Lo}}]", True),  # the space is missing
        _rule(rf"[.!?…‼⁇⁈⁉]{_C}", r"\s+\S", True),
    ],
}
HINDI = [
    *_abbreviations("hi"),
    _rule(rf"[।॥]{_C}", r"", True),
]
IDEOGRAPHIC = [
    # what is cited at the head of a sentence is followed by who says it; cited after a colon it ends with its sentence
    _rule(rf"[。．！？!?｡…][」』]{_C}", r"\s*(?:と|って|という|なんて|の|は|が|も|を|に|で|か)", False),
    _rule(r"[。．！？!?｡…][”」』’]", r"\s*[“「『‘]", True),
    _rule(rf"(?:^|[{MARKS}][{CLOSERS}]*\s*|\n\s*)[“「『‘][^”」』’]*[。．！？!?｡…][”」』’]", r"\s*[\p{Han}\p{Hiragana}\p{Katakana}]", False),
    _rule(rf"[。．！？｡]{_C}", r"", True),
]
THAI = [
    _rule(r"\p{N}", r"[^\S\n]", False),
    _rule(r"", r"[^\S\n]+\p{N}", False),
    _rule(r"[฀-๿]", r"[^\S\n]+ๆ", False),
    _rule(r"[฀-๿]", r"[^\S\n]+[^\s\n]", True),
]
#: No pattern: the position is inside a bracket or quotation that closes later. An empty line ends all of them.
INSIDE = Rule(regex.compile(""), regex.compile(""), False)
_before = [EVERYWHERE[0], EVERYWHERE[1], INSIDE, *EVERYWHERE[2:]]
_hindi = _abbreviations("hi")


def _latin(langs: tuple[str, ...]) -> list[Rule]:
    return [*_before, *_hindi, *IDEOGRAPHIC[:3], *(r for x in langs for r in LATIN[x]), *LATIN[""]]


#: The cascade of each kind of last mark, particular tables before general ones; other kinds' rules couldn't match.
CASCADE = {"thai": [*_before, *THAI], "।॥": [*_before, *HINDI], "。．！？｡": [*_before, *IDEOGRAPHIC]}
#: That of Latin and other spaced scripts, by language; the last where the language isn't known.
BY_LANG = {"vi": _latin(("vi", "en")), "en": _latin(("en",)), "en+": _latin(("en", "vi")), "": _latin(("vi", "en"))}
_vietnamese = regex.compile("[ăâđêôơưĂÂĐÊÔƠƯàảãạáằẳẵặắầẩẫậấèẻẽẹéềểễệếìỉĩịíòỏõọóồổỗộốờởỡợớùủũụúừửữựứỳỷỹỵý]")

_mark = regex.compile(rf"[{MARKS}]+[{CLOSERS}]*|[^\s](?=[^\S\n]*(?:\r?\n[^\S\n]*){{2,}}\S)|[฀-๿](?=[^\S\n])|[\p{{N}}](?=[^\S\n]+[฀-๿])")
_pairs = {"“": "”", "‘": "’", "«": "»", "「": "」", "『": "』", "（": "）", "(": ")", "[": "]", "{": "}", "【": "】", "《": "》"}
_close = {v: k for k, v in _pairs.items()}
_gap = regex.compile(r"\s*")
_empty_line = regex.compile(r"\n[^\S\n]*\n")
_pair = regex.compile("[" + regex.escape("".join([*_pairs, *_close])) + "]")


def _cascade(mark: str, latin: list[Rule]) -> list[Rule]:
    last = mark.rstrip(CLOSERS.replace("\\", ""))[-1:]
    for kind in ("।॥", "。．！？｡"):
        if last and last in kind:
            return CASCADE[kind]
    if mark[-1] >= "\u0e00" and mark[-1] <= "\u0e7f" or mark[-1].isdigit():
        return CASCADE["thai"]
    return latin


class _Pairs:
    """Brackets and quotations that are open at ever later positions, and where they could close; linear in the text."""

    def __init__(self, text: str):
        self.text, self.seen = text, [(m.start(), m.group()) for m in _pair.finditer(text)]
        self.stack: list[str] = []
        self.next = 0
        self.closers: dict[str, list[int]] = {}
        for i, c in self.seen:
            if c in _close:
                self.closers.setdefault(c, []).append(i)
        self.lines = [m.start() for m in _empty_line.finditer(text)] if self.seen else []

    def restart(self, at: int) -> None:
        """A sentence begins here."""
        self.stack.clear()
        self.next = bisect.bisect_left(self.seen, at, self.next, key=lambda x: x[0])

    def around(self, at: int) -> bool:
        """Whether something that opened since the sentence began closes after ``at``, before the next empty line."""
        stack, text = self.stack, self.text
        while self.next < len(self.seen) and self.seen[self.next][0] < at:
            i, c = self.seen[self.next]
            self.next += 1
            if c in _pairs:
                stack.append(c)
            elif _close[c] in stack and not (c == "’" and text[i + 1 : i + 2].isalpha() and "‘" not in stack):
                while stack.pop() != _close[c]:
                    pass
        if not stack:
            return False
        k = bisect.bisect_left(self.lines, at)
        end = self.lines[k] if k < len(self.lines) else len(text)
        for c in set(stack):
            where = self.closers.get(_pairs[c], [])
            k = bisect.bisect_left(where, at)
            if k < len(where) and where[k] < end:
                return True
        return False


def boundaries(text: str | None, lang: str | None = None) -> list[int]:
    """Numbers of characters before each place where a sentence ends and another follows; [] for NULL and blank texts.

    lang is the text's language, if known, in any spelling that begins with its two letters; the texts' scripts count
    whatever it says.
    """
    if not text:
        return []
    out: list[int] = []
    tail = len(text.rstrip())
    code = (lang or "").strip().lower()[:2]
    latin = BY_LANG["" if code not in ("vi", "en") else "en+" if code == "en" and _vietnamese.search(text) else code]
    pairs, since = None, 0
    for m in _mark.finditer(text):
        at = m.end()
        if at >= tail or (out and at <= out[-1]):
            continue
        for rule in _cascade(m.group(), latin):
            if rule is INSIDE:
                if pairs is None:
                    pairs = _Pairs(text)
                    pairs.restart(since)
                if pairs.seen and pairs.around(at):
                    break
            elif rule.after.match(text, at) and (b := rule.before.match(text, 0, at)) and not (rule.apart and b.start() > since and text[b.start() - 1] == "."):
                if rule.ends:
                    out.append(at)
                    since = _gap.match(text, at).end()
                    if pairs:
                        pairs.restart(since)
                break
    return out


@functools.lru_cache(maxsize=1)
def _tables() -> dict[str, np.ndarray]:
    return {
        "mark": cp.table(MARKS),
        "word": cp.category("L") | cp.category("N"),
        "thai": cp.table("".join(map(chr, range(0xE00, 0xE80)))),
        "space": cp.table(test=lambda c: c.isspace() and c != "\n"),
    }


def may_break(u: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Whether a text can have a boundary: a mark with a letter or digit after it, two line feeds, a space after Thai."""
    t = _tables()
    last = cp.last_in(cp.look(t["word"], u, True), begin)
    out = cp.first_in(cp.look(t["mark"], u), begin) < last
    feeds = np.flatnonzero(u == 10)
    out |= np.searchsorted(feeds, begin[1:]) - np.searchsorted(feeds, begin[:-1]) > 1
    thai = np.flatnonzero(cp.look(t["thai"], u[:-1]) & cp.look(t["space"], u[1:])) if len(u) > 1 else np.empty(0, int)
    return out | (np.searchsorted(thai, begin[1:]) > np.searchsorted(thai, begin[:-1]))


def split(text: str | None, lang: str | None = None) -> list[str]:
    """The sentences of a text, in order, without the white space around them; [] for NULL and blank texts."""
    if not text or not text.strip():
        return []
    cuts = [0, *boundaries(text, lang), len(text)]
    return [s for s in (text[a:b].strip() for a, b in zip(cuts, cuts[1:])) if s]


def sentence_ends(df: DataFrame, key: str, text: str, skip=None, lang: str | None = None) -> DataFrame:
    """(key, end_pos) of every boundary. skip: a factory of a function that says which of a list of texts to leave out,
    given also which of them are suspicious of wrong decoding. lang: the column of the texts' language, if there is one.

    NULL and blank texts have none; equal rows are each listed; an empty table gives no rows; other columns are
    ignored. Texts are read whole.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_of = skip() if skip else None
        for b in batches:
            u, begin = cp.points(b.column(1))
            open_ = may_break(u, begin)
            garbled = suspicious(u, begin) if out_of else None
            b = b.filter(pa.array(open_))
            texts = b.column(1).to_pylist()
            left_out = out_of(texts, garbled[open_]) if out_of else [False] * len(texts)
            seen: dict[tuple[str, str | None], list[int]] = {}
            at, ends = [], []
            for i, x in enumerate(zip(texts, b.column(2).to_pylist())):
                if left_out[i]:
                    continue
                if x not in seen:
                    seen[x] = boundaries(*x)
                ends += seen[x]
                at += [i] * len(seen[x])
            yield pa.record_batch([b.column(0).take(pa.array(at, pa.int64())), pa.array(ends, pa.int64())], ["k", "end_pos"])

    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t"), (F.col(lang) if lang else F.lit(None)).cast("string").alias("l"))
    out = rows.mapInArrow(part, f"k {dict(rows.dtypes)['k']}, end_pos bigint")
    return out.select(F.col("k").alias(key), "end_pos")


def sentence_units(df: DataFrame, key: str, text: str, lang: str | None = None) -> DataFrame:
    """(key, sentence_idx from 0, sentence) of every text; NULL and blank texts give no unit."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [split(t, x) for t, x in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            at = [i for i, p in enumerate(parts) for _ in p]
            yield pa.record_batch(
                [b.column(0).take(pa.array(at, pa.int64())), pa.array([j for p in parts for j in range(len(p))], pa.int32()), pa.array([s for p in parts for s in p], pa.string())],
                ["k", "sentence_idx", "sentence"],
            )

    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t"), (F.col(lang) if lang else F.lit(None)).cast("string").alias("l")).filter(F.col("t").isNotNull())
    out = rows.mapInArrow(part, f"k {dict(rows.dtypes)['k']}, sentence_idx int, sentence string")
    return out.select(F.col("k").alias(key), "sentence_idx", "sentence")
