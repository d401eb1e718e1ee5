"""Template residue, filler, error pages and script notices, found by aligning the records that share a template.

Every document is cut into units (lines and sentences). What could stand in a slot (a variable, a blank, a default, a
null marker) is taken out of its unit; the constant words that are left, and the words on either side of the slot, are
hashed. Units with one hash are records of one template: the slot is induced where they hold different values or differ
around it, and a record is residue where its slot kept a variable name, a default or a blank. Forms of variables learned
from induced slots are recognised elsewhere. Error pages are aligned in the same way, unit by unit, with numbers masked:
parts that recur on different pages make a template. Word lists are the evidence that a recurring part is an error, and
they tell sentences that speak about markers, which are residue only where the slot truly varies. `via` says how a row
was found: aligned, learned, repeated, or alone, where nothing in the table is of its template.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessitura.runtime import cut, maybe_broadcast

#: Different units that make a template where the slot's value never varies, and rows that a weak page needs.
SUPPORT = 3
#: Words on either side of a slot that align units whose other words differ, and at either end of a page's unit.
SIDE, END = 2, 3

# Fixed values. Variable markers: what programs replace by a value.
VARIABLE = regex.compile(
    r"\{\{[^{}\n]{0,80}\}\}|\{%[^%\n]{0,80}%\}|<%[^%\n]{0,80}%>|[#$]\{[^{}\n]{0,80}\}|\[\[\s*[A-Za-z_][\w.]*\s*\]\]"
    r"|(?<![{$#])\{\s*(?:\d{1,2}|[A-Za-z_][A-Za-z0-9_.]*)\s*\}(?!\})"
    r"|(?<![\d%])%(?:\d+\$)?[sd](?![\p{L}\p{N}])|%\([A-Za-z_][\w.]*\)[sd]"
    r"|%%[A-Za-z_][\w.]*%%|@@[A-Za-z_][\w.]*@@|\$\$[A-Za-z_][\w.]*\$\$|##[A-Za-z_][\w.]*##|(?<!\w)__[A-Za-z][A-Za-z_.]*__(?!\w)|(?<!\S)~[A-Za-z_][\w.]*~"
    r"|<[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)*>(?<=<[A-Z0-9_]{3,}>)"
    r"|(?m:^#(?:if|end|else|foreach|endif)\b[^\n]*$)"
)
#: Names in capitals; only what recurs counts, as captions write sounds and sections so.
SOFT = regex.compile(r"(?<=\S )\[[A-Z][A-Z0-9_]{2,}\]|(?<![\w@#/.\-\[<{$%])[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)+(?![\w\]>}%])|\[[A-Z][A-Z0-9_]{2,}\](?=,? \S)")
#: Any other identifier between signs, two or more on either side: residue only where the slot is induced.
WRAPPED = regex.compile(r"(?<![\w{<\[%$#@~^|\\*=&(])(?!\*+\w)[{<\[%$#@~^|\\*=&(]{2,4}\s?[A-Za-z_][\w.]{1,40}\s?[}>\])%$#@~^|\\*=&]{2,4}(?!\w)")
FIELD = regex.compile(r"NAME|DATE|TITLE|MAIL|ADDRESS|COMPANY|CITY|COUNTRY|URL|LINK|PHONE|NUMBER|PRICE|AMOUNT|USER|CUSTOMER|CLIENT|PRODUCT|ORDER|CODE|SIGNATURE")
# Null markers, and blanks and defaults that wait for a value.
NULLS = r"undefined|NaN|\[object Object\]|null|None|nil|NULL|N/A|#REF!|#N/A"
BLANK = regex.compile(
    r"[\[<(]{1,2}\s*(?i:(?:vui lòng\s+)?(?:điền|chèn|thêm|nhập|insert|enter|add|fill|type|put|your|to be)\b[^\[\]<>()\n]{0,80})[\])>]{1,2}"
    r"|\[\s*(?i:mã|tên|họ và tên|họ tên|ngày|địa chỉ|số|name|date|title|link|url)\b[^\[\]\n]{0,40}\]"
    r"|\((?i:tên người nhận|tên bạn|chưa có[^()\n]{0,60}|trống|to be [a-z ]+|tba|tbd)\)"
    r"|(?<!\w)_{3,}(?!\w)|(?<![\w])_{1,2}:_{1,2}|(?<!\.)\.{3}/\.{3}(?:/\d*\.{0,3})?|(?<=:\s?)\.{4,}|\.{8,}|(?<=:\s?)\?{2,}(?=\W|$)"
    r"|[“\"]…[^…“”\"\n]{1,40}…[”\"]|(?i:\bdd/mm/y{2,4}\b|\bmm/dd/y{2,4}\b)|(?<=:\s?)(?i:x{3,})\b|\b(?:TODO|TBD|FIXME)\b"
)
NULL_VALUE = regex.compile(
    rf"(?m)^[^\n:]{{1,40}}:\s*(?:{NULLS}|\(trống\)|--)\s*(?=[;|,.]|$)"
    rf"|(?<![\p{{L}}\p{{N}}])(?:{NULLS})\s+[-–|/]\s+(?:{NULLS})(?![\p{{L}}\p{{N}}])|\((?:{NULLS}|--)\s+[^()\n]{{1,12}}\)"
    r"|\[object Object\]|(?<![\p{L}\p{N}])(?:undefined|NaN)(?![\p{L}\p{N}])"
)
#: Words of a sentence that speaks about markers.
MENTION = regex.compile(
    r"(?i)\b(?:ta viết|viết|gõ|câu lệnh|lệnh|in ra|giảng|cú pháp|ký hiệu|mẫu mô tả|để hệ thống|hướng dẫn|giải thích|nghĩa là|biến số|tên biến|dấu ngoặc"
    r"|explain\w*|such as|for example|called|means?|syntax|variable|stands? for|writes?|typed?|prints?|tutorial|lesson|workshop)\b"
)

# Fillers.
LATIN_FILLER = frozenset(
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud "
    "exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur "
    "excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum donec nunc tellus felis ornare porta vivamus "
    "vestibulum mauris pellentesque praesent integer curabitur aenean nullam fusce phasellus".split()
)
#: Those that no other language has as a word.
_LATIN_ONLY = LATIN_FILLER - frozenset("do in ad ex ea ut et id sit sed non est qui sunt minim".split())
MASH = frozenset("asdf asd qwer qwerty zxcv zxc hjkl jkl uiop test abc xyz foo bar baz 123 1234 111 aaa".split())
FILLER_WORD = regex.compile(r"(?i)\b(?:mẫu|chữ thử|thử bố cục|bố cục|giữ chỗ|tạm thời|nội dung thử|placeholder|sample|dummy|filler|test|example text|your text|lorem|demo text)\b")

# Error, access and outage messages, and what surrounds them on a page.
ERROR = regex.compile(
    r"(?i)không tồn tại|không tìm thấy (?:trang|nội dung|kết quả|bản ghi|tệp|đường dẫn|video|địa chỉ|tài liệu|máy chủ)|đã bị (?:xoá|xóa|gỡ|khoá|khóa|chặn)|mã lỗi|lỗi máy chủ|quá tải|tạm ngừng|tạm ngưng|gián đoạn|đang (?:được )?bảo trì|hệ thống đang|không kết nối được"
    r"|mất kết nối|chưa được xử lý|tải lại trang|(?:quay|trở) lại sau|thử lại sau|không khả dụng|chế độ riêng tư|không có quyền|quyền truy cập|phiên (?:đăng nhập|làm việc)"
    r"|đã hết hạn|hết phiên|không xem được|đăng nhập lại|đang khắc phục|quá nhiều yêu cầu|từ chối truy cập"
    r"|\b(?:not found|bad gateway|service unavailable|gateway time-?out|forbidden|internal server error|bad request|unauthori[sz]ed|too many requests|request timeout)\b|^(?:http|error|err)?\W*\d{3}\W+gone\b"
    r"|\b(?:http|error|err)\W*[45]\d\d\b|^[45]\d\d\b|could not (?:be )?(?:load|serve|find|open|reach|connect)\w*|did not (?:answer|respond)|nothing lives at|page you asked|no longer (?:valid|available|exists)"
    r"|access denied|permission (?:missing|denied)|(?:session|token|visit|link)\b.{0,40}\b(?:expired|ended|was cut off|no longer valid)|sign in (?:again )?to|ask an admin|wait a while"
    r"|failed at (?:offset|line|step)|timed? ?out|connection (?:reset|refused)|no response after|^\W*(?:panic|traceback|unhandled exception|fatal|stack trace)\b|under maintenance|temporarily unavailable|try again later"
)
SCRIPT = regex.compile(
    r"(?i)(?:bật|mở|kích hoạt|cho phép|hỗ trợ|cần|chạy|tắt|chặn)\b[^.!?\n]{0,40}\b(?:javascript|js|script|mã kịch bản)\b|nội dung không hiển thị|không tải được|khung trống|cho phép rồi tải lại|đổi trình duyệt"
    r"|(?:requires?|needs?|enable|allow|turn on|without|supports?)\b[^.!?\n]{0,40}\b(?:javascript|scripts?)\b|scripts? (?:is |are )?(?:turned off|disabled|blocked)|javascript (?:is )?(?:disabled|required|off)|client-side code"
    r"|(?:enable|allow|turn) (?:it|on)\b[^.!?\n]{0,20}\b(?:and|to)\b|change the setting"
)
CHROME = regex.compile(r"(?i)^\W*(?:trang chủ|menu|home|đăng nhập|nghe thử ›|tìm kiếm|©|mã\b|ref\b|trace\b|request id|báo cho|quay về|thử tìm|help|search|login|sign in|go back|contact)|^\W*\(?e?\d{1,6}\)?\W*$|[|›–]\s*(?:đăng nhập|trợ giúp|chi tiết|login|help)\s*$")
#: What tells about errors and scripts, not being one.
ABOUT = regex.compile(r"(?i)hôm qua|hôm trước|tuần trước|suốt buổi|may mà|bài thơ|(?:bài hát|câu chuyện) (?:này |đó |ấy )?(?:về|kể|nói)|tập này|số này|kể (?:về|chuyện)|hướng dẫn|giải thích|nói vì sao|theo yêu cầu|\b(?:she|he|they|we|i) (?:sings?|sang|explain\w*|wrote|told|talk\w*)\b|\bsong\b|\blove\b|workshop|tutorial|yesterday|last (?:week|night)")

_sentence = regex.compile(r"(?<=[.!?…。！？।])\s+|\n+")
_word = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_digits = regex.compile(r"\p{N}+")
_ids = regex.compile(r"[A-Za-z0-9_-]*\d[A-Za-z0-9_-]*")
#: What a column's texts must hold (RE2, which has no look-around) for a variable, a blank or a null marker.
MAY_VARY = (
    r"\{\{|\{%|<%|[#$]\{|\[\[|\{\s*(?:\d{1,2}|[A-Za-z_][A-Za-z0-9_.]*)\s*\}|%(?:\d+\$)?[sd]|%\(|%%[A-Za-z_]|@@[A-Za-z_]|\$\$[A-Za-z_]|##[A-Za-z_]|__[A-Za-z]|~[A-Za-z_][\w.]*~"
    r"|<[A-Z][A-Z0-9_]+>|(?m:^#(?:if|end|else|foreach))|[A-Z]_[A-Z]|\[[A-Z][A-Z0-9_]{2,}\]|[{<\[%$#@~^|\\*=&(]{2}\s?[A-Za-z_][\w.]+\s?[}>\])%$#@~^|\\*=&]{2}"
)
MAY_BLANK = (
    r"[\[<(]\s*(?i:(?:vui lòng\s+)?(?:điền|chèn|thêm|nhập|insert|enter|add|fill|type|put|your|to be))|\[\s*(?i:mã|tên|họ|ngày|địa chỉ|số|name|date|title|link|url)"
    r"|\((?i:tên|chưa có|trống|to be|tba|tbd)|___|_:_|\.\.\./|:\s?\.{4}|\.{8}|:\s?\?\?|[“\"]…|(?i:dd/mm|mm/dd)|:\s?(?i:xxx)|TODO|TBD|FIXME|undefined|NaN|null|None|nil|NULL|N/A|#REF|\[object|:\s*--|\(--"
)
#: Weak evidence of an error page in further languages and wordings; only a page that recurs counts.
WEAK = regex.compile(
    r"(?i)\boops\b|something went wrong|try again|erreur|introuvable|page non trouvée|fehler|nicht gefunden|no encontrad[ao]|não encontrad[ao]|errore|non trovat[ao]|ошибка|не найден|エラー|見つかりません|错误|錯誤|找不到|오류|찾을 수 없|ไม่พบ|ข้อผิดพลาด|त्रुटि"
)
#: What a column's texts must hold (RE2) for an error or script message: the patterns themselves, freed of what RE2 reads
#: otherwise; they may begin any unit.
_begin = r"(?:^|\n|[.!?…。！？।][\s\p{Z}])[\s\p{Z}]*"  # RE2's \s knows ASCII only
MAY_FAIL = "(?i)" + "|".join(regex.sub(r"(?<!\[)\^", lambda _: _begin, p.pattern.removeprefix("(?i)").replace(r"\b", "")) for p in (ERROR, SCRIPT, WEAK))
#: Lines of a stack trace; they tell neither for an error nor against it.
TRACE = regex.compile(
    r"^\W*(?:File \"[^\"\n]*\", line \d+|at [\w.$<>/ ]+\(|at \S+:\d+(?::\d+)?\)?$|Caused by:|\d+ more$|#\d+ +(?:0x|/|[\w.:>$-]+\()|goroutine \d+|\S+\.(?:py|js|ts|java|go|c|cc|cpp|rb|php|rs):\d+"
    r"|[\w.$]*(?:Error|Exception)(?::|$))"
)
_source = regex.compile(r"^File \"[^\"\n]*\", line \d+")  # the next line is the code there
_cited = regex.compile(r"[“\"][^”\"]*$|^[^“\"]*[”\"]")
#: Characters for which a message speaks: a sentence up to that is judged whole, in a longer one half of that around each message.
UNIT = 200


def _units(text: str) -> tuple[list[int], list[int]]:
    """Where the units of a text (lines and sentences) begin and end."""
    begin, end = [0], []
    for m in _sentence.finditer(text):
        end.append(m.start())
        begin.append(m.end())
    return begin, [*end, len(text)]


def _hash(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\x1f".join(parts)) - (1 << 63)


def _aligned(unit: str, spans: list[tuple[int, int]]) -> tuple[list[str], list[int]]:
    """The unit's words, numbers masked, with ␞ for each slot; and the slots' positions among them."""
    words, at, i = [], [], 0
    for a, b in spans:
        words += _word.findall(unit[i:a])
        at.append(len(words))
        words.append("␞")
        i = b
    words += _word.findall(unit[i:])
    return [_digits.sub("0", w.lower()) for w in words], at


def _shape(value: str) -> str:
    """The form of a variable without its name: the signs around it."""
    return regex.sub(r"[\p{L}\p{M}\p{N}_.:\s]+", "a", value)[:12]


def slots(text: str, vary: bool = True, blank: bool = True) -> list[tuple[str, bool, list[int], int, str, str]]:
    """(reason, whether the sentence speaks about it, hashes that align it, hash of its unit, value, shape) of each slot.

    reason is marker, blank, soft or wrapped. The hashes are of the whole unit's constant words and of the words on either side.
    """
    found = []
    if vary:
        found += [(m.start(), m.end(), "marker") for m in VARIABLE.finditer(text)] + [(m.start(), m.end(), "soft") for m in SOFT.finditer(text) if FIELD.search(m.group())]
        found += [(m.start(), m.end(), "wrapped") for m in WRAPPED.finditer(text)]
    if blank:
        found += [(m.start(), m.end(), "blank") for p in (BLANK, NULL_VALUE) for m in p.finditer(text)]
    if not found:
        return []
    begin, end = _units(text)
    by_unit: dict[int, list[tuple[int, int, str]]] = {}
    for a, b, reason in sorted(found, key=lambda x: (x[0], -x[1])):
        mine = by_unit.setdefault(bisect.bisect_right(begin, a) - 1, [])
        if not mine or a >= mine[-1][1]:
            mine.append((a, b, reason))
    out = []
    for k, mine in by_unit.items():
        lo, hi = begin[k], max(end[k], mine[-1][1])
        unit = text[lo:hi]
        words, at = _aligned(unit, [(a - lo, b - lo) for a, b, _ in mine])
        rest = "".join(unit[i:j] for i, j in zip([0, *(b - lo for _, b, _ in mine)], [*(a - lo for a, _, _ in mine), len(unit)]))
        about = bool(MENTION.search(rest))
        whole, same = _hash("unit", *words), _hash(_digits.sub("0", unit.lower()))
        for (a, b, reason), i in zip(mine, at):
            if reason == "marker" and regex.fullmatch(r"\s*\{\s*[A-Za-z_][A-Za-z0-9_.]*\s*\}\s*", unit):
                continue  # a word in braces on its own line is a stage direction
            keys = [whole] if len(words) > len(mine) else [_hash("inside", *(w := _word.findall(unit.lower()))[:1], *w[-2:])]
            left, right = words[max(0, i - SIDE) : i], words[i + 1 : i + 1 + SIDE]
            if left and "␞" not in left:
                keys.append(_hash("left", *left))
            if right and "␞" not in right:
                keys.append(_hash("right", *right))
            out.append((reason, about, keys, same, text[a:b], _shape(text[a:b])))
    return out


def periods(ws: list[str]) -> Iterator[int]:
    """Periods of two words or more, whatever their length, that begin with a full repeat and that nine of ten words keep."""
    n = len(ws)
    at = 1
    while True:  # nearly all texts end here
        try:
            at = ws.index(ws[0], at + 1)
        except ValueError:
            return
        if ws[at : at + 2] == ws[:2]:
            break
    z, left, right = [0] * (n // 3 + 1), 0, 0  # how far the words from i on equal the first ones
    for i in range(1, n // 3 + 1):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and ws[k] == ws[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    number: dict[str, int] = {}
    u = np.array([number.setdefault(w, len(number)) for w in ws])
    roots = [1]
    for p in range(2, n // 3 + 1):
        # beyond short ones, a multiple of a period that its words keep as well adds nothing
        if z[p] < p or (p > 12 and any(p % q == 0 and q + z[q] >= 2 * p for q in roots)):
            continue
        roots.append(p)
        if np.count_nonzero(u[p:] == u[:-p]) >= 0.9 * (n - p):
            yield p


def filler(text: str) -> str:
    """What kind of dummy text the body is, else '': latin, keys, or the phrase that it repeats over and over."""
    ws = _word.findall(text.lower())
    n = len(ws)
    if n < 4:
        return ""
    latin = sum(w in LATIN_FILLER for w in ws)
    if latin >= 0.6 * n and n >= 6 and sum(w in ("lorem", "ipsum", "dolor", "amet", "velit", "tellus", "donec", "magna") for w in ws) >= 0.1 * n:
        return "latin"
    if n >= 5 and sum(w in MASH or w.isdigit() for w in ws) >= 0.8 * n and sum(w in MASH and not w.isdigit() for w in ws) >= 0.5 * n:
        return "keys"
    for period in periods(ws):
        phrase = " ".join(ws[:period])
        return phrase if FILLER_WORD.search(phrase) or (period >= 3 and n >= 8 * period) else ""
    # filler that makes up most of a longer text
    if latin < 0.2 * n:
        return ""
    units = [u for u in _sentence.split(text) if u.strip()]
    dummy = sum(len(u) for u in units if (t := [w.lower() for w in _word.findall(u)]) and len(t) >= 4 and sum(w in LATIN_FILLER for w in t) >= 0.8 * len(t))
    return "latin" if dummy > 0.5 * len(text) else ""


def _message(unit: str) -> int:
    """How many of a unit's characters belong to error or script messages."""
    if len(unit) <= UNIT:
        return len(unit) * (bool(ERROR.search(unit) or SCRIPT.search(unit)) and not ABOUT.search(unit) and not _cited.search(unit))
    n = end = 0
    for m in sorted([*ERROR.finditer(unit), *SCRIPT.finditer(unit)], key=lambda m: m.start()):
        a, b = max(0, m.start() - UNIT // 4), min(len(unit), m.end() + UNIT // 4)
        if b > end and not ABOUT.search(unit, a, b) and not _cited.search(unit[a:b]):
            n, end = n + b - max(a, end), b
    return n


def page(text: str) -> tuple[int, list[str]]:
    """(evidence, units) of an error page or script notice: 2 if messages outweigh the rest, 1 if the page must recur,
    0 if it is none. Messages are weighed whatever the length of the text."""
    begin, end = _units(text)
    units = [u for a, b in zip(begin, end) if (u := text[a:b].strip())]
    messages = [_message(u) for u in units]
    if not any(messages):
        hint = sum(len(u) for u in units if WEAK.search(u) and not ABOUT.search(u))
        return (1, units) if hint and 2 * hint >= sum(map(len, units)) else (0, [])
    real, code = 0, False
    for u, n in zip(units, messages):
        aside = code or TRACE.search(u) or len(_word.findall(u)) <= 2 or (len(u) <= UNIT and CHROME.search(u))
        real += 0 if n and len(u) <= UNIT or aside else len(u) - n
        code = bool(_source.search(u))
    if sum(messages) >= real:
        return 2, [u for u, n in zip(units, messages) if n]
    return (0, []) if any(ABOUT.search(u) for u in units) else (1, units)


def _page_keys(units: list[str]) -> list[int]:
    """Hashes that align the units of pages: their words with numbers masked, whole, and at either end."""
    out = set()
    for u in units:
        w = [_digits.sub("0", x) for x in _word.findall(_ids.sub("0", u.lower()))]
        if len(w) > 1:
            out |= {_hash("page", *w), _hash("head", *w[:END]), _hash("tail", *w[-END:])}
    return sorted(out)


def _may_fill(low: str) -> bool:
    """Whether a lower-cased text can be filler: its first two words come again, or it has words of fillers."""
    ws = low.split()
    return (len(ws) > 3 and low.count(ws[0]) > 2 and low.count(ws[1].strip(".,;:!?…")) > 2) or not _LATIN_ONLY.isdisjoint(ws) or not MASH.isdisjoint(ws)


#: What makes a row of each need residue, from the counts of its keys.
_NEEDS = {
    "slot": "lo != hi or n_units >= {s}",
    "about": "lo != hi and n_units >= {s}",
    "soft": "n_rows >= {s}",
    "page": "n_units >= 2",
    "form": "n_units >= {s}",
    "whole": "n_rows >= {s}",
    "filler": "n_units >= 2",
}


def find_residue(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, reason, via) of documents that are or hold residue; reason is marker, blank, filler or page.

    NULL and empty texts are never residue; each stored row is judged; an empty table gives no rows; other columns are
    ignored. Counts are partial before the exchange, and copies of a unit count once, so that neither hot templates nor
    copies gather in a task.
    """
    rows = df.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).filter(F.length(F.trim("t")) > 0)
    kind = dict(rows.dtypes)["d"]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["reason", "need", "sure", "key", "unit", "value", "shape"]
        types = [pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

        def judge(t: str, fail: bool, vary: bool, blank: bool) -> list[tuple]:
            low = t.lower()
            if _may_fill(low) and (phrase := filler(t)):
                return [("filler", "filler", True, _hash("filler", phrase), _hash(low), 0, None)]
            found = slots(t, vary, blank) if vary or blank else []
            if gaps := [x for x in found if x[0] == "blank" and not x[1]]:
                return [("blank", "slot", True, k, unit, _hash(value), shape) for _, _, keys, unit, value, shape in gaps for k in keys]
            evidence, units = page(t) if fail else (0, [])
            if evidence == 2:
                whole = _hash(_ids.sub("0", low))
                return [("page", "page", True, k, whole, 0, None) for k in _page_keys(units) or [whole]]
            out = []
            if evidence == 1:
                out.append(("page", "form" if len(units) > 1 and any(map(_message, units)) else "whole", False, _hash("form", _ids.sub("0", low)), _hash(low), 0, None))
            for reason, about, keys, unit, value, shape in found:
                if reason == "soft" and not about:
                    out += [("marker", "soft", False, k, unit, _hash(value), None) for k in keys]
                elif reason == "wrapped":
                    out += [("marker", "about" if about else "slot", False, k, unit, _hash(value), None) for k in keys]
                elif reason == "marker":
                    out += [("marker", "about" if about else "slot", not about, k, unit, _hash(value), shape) for k in keys]
            return out

        for b in batches:
            d = b.column(1).dictionary_encode()  # copies in a batch are judged once
            texts = d.dictionary
            fail, vary, blank = (pc.match_substring_regex(texts, p).to_pylist() for p in (MAY_FAIL, MAY_VARY, MAY_BLANK))
            judged = [judge(*x) for x in zip(texts.to_pylist(), fail, vary, blank)]
            of = d.indices.to_pylist()
            at = [i for i, j in enumerate(of) for _ in judged[j]]
            flat = [r for j in of for r in judged[j]]
            columns = zip(*flat) if flat else [[]] * len(names)
            yield pa.record_batch([b.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, types))], ["d", *names])

    # the candidates are few beside the texts; kept, so that texts are judged once
    seen = cut(rows.mapInArrow(part, f"d {kind}, reason string, need string, sure boolean, key bigint, unit bigint, value bigint, shape string"))
    units = seen.groupBy("key", "unit").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count_distinct("d").alias("n_rows"))
    keys = units.groupBy("key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("n_units"), F.sum("n_rows").alias("n_rows"))
    held = F.lit(False)
    for need, rule in _NEEDS.items():
        held = held | ((F.col("need") == need) & F.expr(rule.format(s=SUPPORT)))
    known = seen.join(maybe_broadcast(keys), "key").withColumn("held", held)
    learned = known.filter(F.col("held") & (F.col("need") == "slot") & (F.col("reason") == "marker")).groupBy("shape").agg((F.min("value") != F.max("value")).alias("learned")).filter("learned")
    via = (
        F.when(F.col("held"), F.when(F.col("need").isin("slot", "about"), "aligned").otherwise("repeated"))
        .when(F.col("sure") & F.col("learned"), "learned")
        .when(F.col("sure"), "zalone")
    )
    out = known.join(maybe_broadcast(learned), "shape", "left").withColumn("via", via).filter(F.col("via").isNotNull())
    best = out.groupBy("d").agg(F.min("reason").alias("reason"), F.min("via").alias("via"))
    return best.select(F.col("d").alias(doc_id), "reason", F.regexp_replace("via", "^z", "").alias("via"))


def without_residue(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """df without the documents of find_residue; all its columns and other rows, NULL texts included, stay."""
    bad = find_residue(df, doc_id, text).select(F.col(doc_id).alias("_bad"))
    return df.join(bad, F.col(doc_id) == F.col("_bad"), "left_anti")
