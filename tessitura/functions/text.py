"""Text functions of captions and transcripts: Column → Column.

Native expressions where Java's regular expressions agree with the wanted classes; Arrow functions, once a distinct
value, where full Unicode is needed (NFC, case folding, HTML entities). NULL gives NULL unless said otherwise.
"""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
BLOCKLIST = (
    "cảm ơn các bạn đã theo dõi",
    "cảm ơn các bạn đã xem video",
    "cảm ơn các bạn đã xem",
    "cảm ơn các bạn đã lắng nghe",
    "cảm ơn đã theo dõi",
    "hãy đăng ký kênh",
    "đừng quên đăng ký kênh",
    "nhớ đăng ký kênh",
    "hãy like và đăng ký kênh",
    "hãy nhấn like và đăng ký kênh",
    "hẹn gặp lại các bạn",
    "ghiền mì gõ",
    "thank you for watching",
    "thanks for watching",
    "please subscribe",
    "like and subscribe",
)
PROMO = ("đăng ký kênh", "subscribe cho kênh", "ghiền mì gõ", "la la school", "bỏ lỡ những video", "nhấn chuông", "like và đăng ký")
ACRONYMS = ("nato", "fifa", "asean", "wto", "fbi", "atm", "usb", "gdp", "wifi")
PROPER_NOUNS = {"youtube": "YouTube", "facebook": "Facebook", "tiktok": "TikTok", "google": "Google", "instagram": "Instagram"}
MUSIC_TITLES = ("official mv", "music video", "lyric", "lyrics", "official audio", " ft.", " feat.", "m/v", "| official")
ADLIBS = ("na", "la", "oh", "ohh", "ooh", "ooo", "hey", "ah", "uh", "yeah", "wo", "woah")

_WORD = r"\p{L}\p{N}_"


def _per_value(f):
    """An Arrow function that runs f once a distinct value; NULL stays NULL."""

    def run(s: pd.Series) -> pd.Series:
        codes, values = pd.factorize(s)
        done = [f(v) for v in values]
        return pd.Series([done[c] if c >= 0 else None for c in codes], dtype=object)

    run.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")


def nfc(c: Column) -> Column:
    return _per_value(lambda v: unicodedata.normalize("NFC", v))(c)


def casefold(c: Column) -> Column:
    """NFC and full case folding (ß → ss, unlike lower)."""
    return _per_value(lambda v: unicodedata.normalize("NFC", v).casefold())(c)


def _both_forms(c: Column) -> Column:
    """struct(folded, composed): casefold() and nfc() in one pass."""

    def run(s: pd.Series) -> pd.DataFrame:
        codes, values = pd.factorize(s)
        done = [unicodedata.normalize("NFC", v) for v in values]
        return pd.DataFrame({"folded": [done[c].casefold() if c >= 0 else None for c in codes], "composed": [done[c] if c >= 0 else None for c in codes]})

    run.__annotations__ = {"s": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(run, "folded string, composed string")(c)


def unescape_html(c: Column) -> Column:
    return _per_value(html.unescape)(c)


def strip_diacritics(c: Column) -> Column:
    """Base letters; đ becomes d."""
    def bare(v: str) -> str:
        return unicodedata.normalize("NFC", "".join(x for x in unicodedata.normalize("NFD", v) if not unicodedata.combining(x)))

    return _per_value(bare)(F.translate(c, "đĐ", "dD"))


def squeeze(c: Column) -> Column:
    """White space runs to one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def compare_form(c: Column) -> Column:
    """For comparing whole texts: case folded, punctuation to spaces."""
    return squeeze(F.regexp_replace(casefold(c), rf"[^{_WORD}\s]", " "))


def _is_blocklisted(form: Column) -> Column:
    return F.coalesce(form.isin(list(BLOCKLIST)), F.lit(False))


def _has_promo(form: Column) -> Column:
    return F.coalesce(form.rlike("|".join(PROMO)), F.lit(False))


def is_blocklisted(c: Column) -> Column:
    """Whether the whole text is a phrase of the blocklist."""
    return _is_blocklisted(compare_form(c))


def has_promo(c: Column) -> Column:
    """Whether a promotional phrase occurs in the text."""
    return _has_promo(compare_form(c))


def is_music_title(c: Column, more: tuple[str, ...] | str = ()) -> Column:
    """Whether a title speaks of music; more: further keywords, or a comma-separated list of them."""
    extra = [k.strip() for k in more.split(",")] if isinstance(more, str) else more
    pattern = "|".join(f"\\Q{k.casefold()}\\E" for k in (*MUSIC_TITLES, *filter(None, extra)))
    return F.coalesce(F.lower(c).rlike(pattern), F.lit(False))


def tokens(c: Column) -> Column:
    """Words between white space; [] for blank text."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"(?U)\s+"), lambda x: x != "")


def characters(c: Column) -> Column:
    """Characters that aren't white space; [] for blank text."""
    bare = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s", "")
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, ""))


def longest_repeat(c: Column) -> Column:
    """Length of the longest run of one word; 0 for blank text."""
    start = F.struct(F.lit(None).cast("string").alias("w"), F.lit(0).alias("n"), F.lit(0).alias("most"))

    def step(acc: Column, w: Column) -> Column:
        n = F.when(acc["w"] == w, acc["n"] + 1).otherwise(1)
        return F.struct(w.alias("w"), n.alias("n"), F.greatest(acc["most"], n).alias("most"))

    return F.aggregate(tokens(c), start, step, lambda acc: acc["most"])


def has_excessive_repetition(c: Column, limit: int = 10) -> Column:
    return longest_repeat(c) > limit


def collapse_repetition(c: Column, most: int = 6) -> Column:
    """At most ``most`` of each run of one word; '' for NULL."""
    words = tokens(c)
    full = lambda w, i: F.forall(F.sequence(F.lit(1), F.lit(most)), lambda j: F.get(words, i - j) == w)
    return F.array_join(F.filter(words, lambda w, i: (i < most) | ~full(w, i)), " ")


def collapse_adlibs(c: Column) -> Column:
    """Without runs of two or more ad-lib words."""
    padded = F.concat(F.lit(" "), c, F.lit(" "))
    return squeeze(F.regexp_replace(padded, rf"(?<= )(?:(?:{'|'.join(ADLIBS)}) ){{2,}}", ""))


def vlsp(c: Column) -> Column:
    """Spelled-out acronyms joined, proper nouns in their own spelling; case and punctuation stay. '' for NULL."""
    return _vlsp(nfc(F.coalesce(c, F.lit(""))))


def _vlsp(out: Column) -> Column:
    for a in ACRONYMS:
        out = F.regexp_replace(out, r"(?iU)\b" + r"[\s.\-]+".join(a) + r"\b", a)
    for low, own in PROPER_NOUNS.items():
        out = F.regexp_replace(out, rf"(?iU)\b{low}\b", own)
    return squeeze(out)


def clean_transcript(c: Column, no_speech: Column | None = None, logprob: Column | None = None, no_speech_max: float = 0.6, logprob_min: float = -1.0, limit: int = 10) -> Column:
    """'' for blank, improbable, blocklisted, promotional or looping text; else its vlsp form."""
    both = _both_forms(F.coalesce(c, F.lit("")))  # Python is entered once a text
    form = squeeze(F.regexp_replace(both["folded"], rf"[^{_WORD}\s]", " "))
    listed = F.transform(F.array(form), lambda f: _is_blocklisted(f) | _has_promo(f))[0]
    bad = listed | has_excessive_repetition(c, limit)
    if no_speech is not None and logprob is not None:
        bad |= F.coalesce((no_speech > no_speech_max) & (logprob < logprob_min), F.lit(False))
    return F.when(F.coalesce(F.trim(c), F.lit("")) == "", "").when(bad, "").otherwise(_vlsp(both["composed"]))


def wer_form(c: Column, level: str = "normalized", phrases: tuple[str, ...] = (), diacritics: bool = True) -> Column:
    """Text as it is compared for word errors; '' for NULL. Level raw keeps brackets' words and ad-libs."""
    out = F.lower(nfc(F.coalesce(c, F.lit(""))))
    if level == "normalized":
        out = F.regexp_replace(out, r"[\[\(][^\]\)]*[\]\)]", " ")
        out = F.regexp_replace(out, r">>+|&gt;", " ")
    out = squeeze(F.regexp_replace(out, rf"[^{_WORD}\s]", " "))
    if level == "normalized":
        for p in sorted(phrases, key=len, reverse=True):
            out = squeeze(F.regexp_replace(F.concat(F.lit(" "), out, F.lit(" ")), rf"(?<= )\Q{p.lower()}\E(?= )", " "))
        out = collapse_adlibs(out)
    return squeeze(out if diacritics else strip_diacritics(out))


def caption_text(c: Column) -> Column:
    """A caption line without inline times, tags and entities."""
    out = F.regexp_replace(c, r"<\d{2}:\d{2}:\d{2}\.\d{3}>|<\d{2}:\d{2}\.\d{3}>", " ")
    return squeeze(unescape_html(F.regexp_replace(out, r"<[^>]+>", " ")))


def slug(c: Column) -> Column:
    """File-name form: other than word characters, dots and dashes to one underscore; 'unknown' where nothing is left."""
    out = F.regexp_replace(F.trim(c), rf"[^{_WORD}.\-]+", "_")
    out = F.regexp_replace(F.regexp_replace(out, "_+", "_"), r"^[._]+|[._]+$", "")
    return F.when(F.coalesce(out, F.lit("")) == "", "unknown").otherwise(out)


def match_key(c: Column) -> Column:
    """A word as lyrics are matched: raw word-error form without spaces."""
    return F.regexp_replace(wer_form(c, "raw"), " ", "")
