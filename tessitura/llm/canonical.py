"""Text that looks the same brought to one form, and texts that hold forms other than the ordinary one.

Method: compatibility normalisation in composed form, full case folding, mapped white space and removal of
default-ignorable characters, once a distinct value of a batch. ordinary() is the part of it that keeps what reads
otherwise (case, ½, ², ™); a text is in another form where its ordinary form isn't the text. canonical() folds the
ordinary form. Look-alike letters of another script are mapped within words of the Latin script, by the table of
confusable characters in the ICU library that Spark brings along. What belongs to its script or emoji (joiners in
Persian, Indic and emoji sequences, Thai SARA AM, full-width punctuation beside ideographs) isn't a different form.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessitura.llm import codepoints as cp

# Letters that look like a Latin letter, in natural order; what is at hand where no session is. Letters of
# other scripts come from confusables().
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХавеѕіјкмнорсԁтухһԛԝѡ", "ABESIJKMHOPCTYXaвesijkмнopcdтyxhqwω"))
CYRILLIC = {k: v for k, v in CYRILLIC.items() if v.isascii()}
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαινορυ", "ABEZHIKMNOPTYXaivopu"))
LATIN = dict(zip("ÐƉ", "ĐĐ"))
LOOKS = CYRILLIC | GREEK | dict(zip("ɑɡɩոօ", "agino"))

#: Spaces other than the plain one; the ideographic space belongs to its script.
SPACES = "\u00a0\u1680\u2000-\u200a\u202f\u205f"
#: Default-ignorable and other invisible characters.
HIDDEN = (
    "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180e\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164"
    "\ufe00-\ufe0f\ufeff\uffa0\ufff9-\ufffb\U000e0000-\U000e0fff"
)
HYPHENS = "‐\u2011﹣－"

_space = regex.compile(f"[{SPACES}]")
_hidden = regex.compile(f"[{HIDDEN}]")
_hyphen = regex.compile(f"[{HYPHENS}]")
#: Scripts in which ZWNJ and ZWJ shape the letters, or whose direction marks do something.
_joining = r"[\p{Arabic}\p{Syriac}\p{Mongolian}\p{Devanagari}\p{Bengali}\p{Gurmukhi}\p{Gujarati}\p{Oriya}\p{Tamil}\p{Telugu}\p{Kannada}\p{Malayalam}\p{Sinhala}\p{Myanmar}\p{Khmer}]"
_emoji = r"[\p{Extended_Pictographic}\p{Emoji_Modifier}\U0001F1E6-\U0001F1FF\ufe0f⃣]"
_belongs = regex.compile(
    rf"(?<={_joining}\p{{M}}*)[\u200c\u200d](?=\p{{M}}*{_joining})"
    rf"|(?<={_emoji})\u200d(?={_emoji})"
    rf"|(?<=[\p{{Extended_Pictographic}}0-9#*])\ufe0f"
    rf"|(?<=\p{{Han}})[\ufe00-\ufe0f\U000e0100-\U000e01ef]"
    rf"|(?<=\p{{Mongolian}})[\u180b-\u180e]|(?<=\p{{Hangul}})\u3164"
    rf"|(?<=\U0001F3F4[\U000e0020-\U000e007e]*)[\U000e0020-\U000e007f]"
    r"|(?<=[\p{Arabic}\p{Hebrew}][^\p{L}]*)[\u200e\u200f\u061c\u202a-\u202e\u2066-\u2069]|[\u200e\u200f\u061c\u202a-\u202e\u2066-\u2069](?=[^\p{L}]*[\p{Arabic}\p{Hebrew}])"
)
#: A letter with marks that may compose, marks that stand for other marks, and jamo.
_marks = regex.compile(r"\p{L}\p{M}+|[\u0340\u0341\u0343\u0344]|[ᄀ-ᄒ][ᅡ-ᅵ][ᆨ-ᇂ]?")
#: Full-width spaces and separators of lines where no ideograph or full-width sign stands beside them.
_wide_space = regex.compile(r"(?<![\p{Han}\p{Hiragana}\p{Katakana}\u3000-\u303f\uff00-\uffef])\u3000(?![\p{Han}\p{Hiragana}\p{Katakana}\u3000-\u303f\uff00-\uffef])")
_word = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_latin = regex.compile(r"\p{Latin}")
_eth = regex.compile(r"[ÐƉ]")


def _compatible(c: str) -> bool:
    """Whether a character is a letter or digit in another form that reads as its compatibility decomposition."""
    d = unicodedata.decomposition(c)
    kind = d.split(">")[0] + ">" if d.startswith("<") else ""
    if unicodedata.category(c) not in ("Lu", "Ll", "Lt", "Lo", "Nd", "Nl"):
        return kind == "<compat>" and "⼀" <= c <= "⿕"
    if kind in ("<wide>", "<narrow>", "<font>", "<isolated>", "<initial>", "<medial>", "<final>"):
        return True
    return kind == "<compat>" and ("ﬀ" <= c <= "ﬗ" or c == "ſ")


OTHER_FORMS = "".join(c for c in map(chr, (*range(0x2000, 0x3400), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800), *range(0x1EE00, 0x1EF00), 0x17F)) if _compatible(c))
#: A text without any of these (Java and Python) is in the ordinary form.
MAY_DIFFER = r"[^\x00-\x7F]"
_other_form = {ord(c): unicodedata.normalize("NFKC", c) for c in OTHER_FORMS}


@functools.lru_cache(maxsize=1)
def confusables(spark: SparkSession) -> dict[str, str]:
    """Letters of other alphabets that Unicode's table of confusables takes for an ASCII letter, of the same case where
    there is one."""
    checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    plain: dict[str, list[str]] = {}
    for c in map(chr, range(ord("A"), ord("z") + 1)):
        if c.isalpha():
            plain.setdefault(checker.getSkeleton(c), []).append(c)
    letters = [c for c in map(chr, range(0x370, 0x1F000)) if unicodedata.category(c) in ("Lu", "Ll") or "ꓐ" <= c <= "ꓽ"]
    letters = [c for c in letters if regex.match(r"[^\p{Latin}\p{Common}]", c)]
    skeletons = checker.getSkeleton("\n".join(letters)).split("\n")
    like = {c: plain[s] for c, s in zip(letters, skeletons) if s in plain}
    return LOOKS | {c: next((x for x in of if x.isupper() == c.isupper()), of[0]) for c, of in like.items()}


def _look_alikes(text: str, looks: dict[str, str]) -> list[int]:
    """Places of letters that another script's letters stand in for."""
    out = []
    for m in _eth.finditer(text):
        # an eth belongs to Icelandic and its kin, which never begin a word with it beside Vietnamese letters
        w = next((x for x in _word.finditer(text) if x.start() <= m.start() < x.end()), None)
        if w is None or not regex.search(r"[þðæøöǫɖɛɔƒŋʋɣ]", w.group().lower().replace("ð", "", 1) if m.group() == "Ð" and w.start() == m.start() else w.group()[1:]):
            out.append(m.start())
    if looks.keys().isdisjoint(text):
        return out
    words = list(_word.finditer(text))
    # whether some word is truly written in another script: it has a letter that looks like no Latin one
    own = any(not _latin.search(w := m.group()) and any(c.isalpha() and c not in looks and unicodedata.bidirectional(c) == "L" and (c.isupper() or c.islower()) for c in unicodedata.normalize("NFC", w)) for m in words)
    for m in words:
        w = m.group()
        odd = [i for i, c in enumerate(w) if c in looks]
        if not odd:
            continue
        mixed = bool(_latin.search(w)) or bool(regex.fullmatch(r"\p{N}+.*|.*\p{N}", w)) and not own
        alone = all(c in looks or not c.isalpha() for c in w) and not own and bool(_latin.search(text))
        if mixed or alone:
            out += [m.start() + i for i in odd]
    return out


@functools.lru_cache(maxsize=2)
def _open(letters: str) -> np.ndarray:
    """Truth table of the characters that ordinary() may change; other characters never are."""
    t = cp.category("M") | cp.table("".join(c for c in (*letters, *OTHER_FORMS, *LATIN) if ord(c) < cp.PLANE))
    for pattern in (_space, _hidden, _hyphen, regex.compile("[ᄀ-ᇿ\u3000]")):
        t = t | cp.table(test=lambda c: pattern.match(c) is not None)
    return t


def may_change(column: pa.Array, looks: dict[str, str]) -> np.ndarray:
    """Which texts of a column hold a character that ordinary() may change."""
    u, begin = cp.points(column)
    return cp.any_in(cp.look(_open("".join(looks)), u, True), begin)


def ordinary(text: str | None, looks: dict[str, str] = LOOKS) -> str | None:
    """The text with every character in its ordinary form, where that reads the same; NULL stays NULL."""
    if not text or text.isascii():
        return text
    if at := _look_alikes(text, looks):
        chars = list(text)
        for i in at:
            chars[i] = LATIN.get(chars[i]) or looks.get(chars[i], chars[i])
        text = "".join(chars)
    if _hidden.search(text):
        keep = {m.start() for m in _belongs.finditer(text)}
        text = _hidden.sub(lambda m: m.group() if m.start() in keep else "", text)
    text = _hyphen.sub("-", _wide_space.sub(" ", _space.sub(" ", text))).translate(_other_form)
    return _marks.sub(lambda m: x if len(x := unicodedata.normalize("NFC", m.group())) < len(m.group()) or not m.group()[0].isalpha() else m.group(), text)


def differs(text: str | None, looks: dict[str, str] = LOOKS) -> bool:
    """Whether a text has a character in another form than the ordinary one that reads the same."""
    return ordinary(text, looks) != text


def canonical(text: str | None, looks: dict[str, str] = LOOKS) -> str | None:
    """One form for comparison: the ordinary form in NFKC, case folded, white space single, ignorable characters gone.

    NULL stays NULL; '' stays ''.
    """
    if not text:
        return text
    if text.isascii():
        return " ".join(text.casefold().split())
    text = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", ordinary(text, looks)).casefold())
    return " ".join(text.split())


def _per_distinct(column: pa.ChunkedArray | pa.Array, f, kind: pa.DataType) -> pa.Array:
    d = pc.dictionary_encode(column)
    return pa.array([f(v) for v in d.dictionary.to_pylist()], kind).take(d.indices)


def different_forms(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field) of each text that isn't its ordinary form; each stored row counts, NULL, empty and plain texts never do.

    An empty table gives no rows; other columns are ignored.
    """
    looks = confusables(df.sparkSession)
    long = df.select(F.col(key).alias("k"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("t")) for f in fields])).alias("x"))
    long = long.select("k", "x.field", "x.t").filter(F.col("t").rlike(MAY_DIFFER))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(may_change(b.column(2), looks)))
            yield b.filter(_per_distinct(b.column(2), lambda t: differs(t, looks), pa.bool_())).select([0, 1])

    return long.mapInArrow(part, f"k {dict(long.dtypes)['k']}, field string").select(F.col("k").alias(key), "field")


def canonical_columns(df: DataFrame, fields: list[str], suffix: str = "_canonical") -> DataFrame:
    """df with a column of the one form for each field; all rows and other columns stay as they are."""

    looks = confusables(df.sparkSession)

    @F.pandas_udf("string")
    def one(s):
        import pandas as pd

        codes, values = pd.factorize(s)
        done = [canonical(v, looks) for v in values]
        return pd.Series([done[c] if c >= 0 else None for c in codes], dtype=object)

    return df.withColumns({f + suffix: one(F.col(f)) for f in fields})
