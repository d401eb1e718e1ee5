"""Images of UTF-8 bytes under the encodings that text is wrongly decoded with."""

from __future__ import annotations

import functools

import regex

#: The single-byte encodings whose images are searched, in natural order.
SINGLE = ("cp1252", "cp1250", "cp1251", "cp1258", "mac_roman", "cp437", "cp850", "koi8_r", "iso8859_2", "iso8859_15", "cp874", "cp1253", "cp1254", "cp1256", "cp1257")
#: The multi-byte encodings tried on runs of characters beyond ASCII.
MULTI = ("gb18030", "big5", "cp932", "cp949", "utf-16-le", "utf-16-be")


@functools.lru_cache(maxsize=None)
def byte_of(codec: str) -> dict[str, int]:
    """Character → byte; what the encoding leaves undefined stands as the control character of that number."""
    out = {}
    for b in range(128, 256):
        try:
            out[bytes([b]).decode(codec)] = b
        except UnicodeDecodeError:
            out[chr(b)] = b
    if codec == "cp1252":  # the same text may come through ISO 8859-1, which keeps the controls
        out |= {chr(b): b for b in range(128, 160) if chr(b) not in out}
    return out


def _any(chars: list[str]) -> str:
    return "[" + "".join(map(regex.escape, sorted(chars))) + "]"


def image(char: str, codec: str) -> str:
    """How the UTF-8 bytes of a character show under an encoding."""
    of = {b: c for c, b in byte_of(codec).items()}
    return "".join(of[b] if b > 127 else chr(b) for b in char.encode())


@functools.lru_cache(maxsize=None)
def sequence(codec: str) -> regex.Pattern:
    """Images of whole UTF-8 sequences; U+FFFD stands for a byte that was lost."""
    of = byte_of(codec)
    part = lambda lo, hi, lost="": _any([c for c, b in of.items() if lo <= b < hi] + ([lost] if lost else []))
    cont = part(0x80, 0xC0, "�")
    return regex.compile(f"{part(0xC2, 0xE0)}{cont}|{part(0xE0, 0xF0)}{cont}{{2}}|{part(0xF0, 0xF5)}{cont}{{3}}")


@functools.lru_cache(maxsize=None)
def leads(codec: str) -> frozenset[str]:
    """Images of the bytes that a UTF-8 sequence begins with."""
    return frozenset(c for c, b in byte_of(codec).items() if 0xC2 <= b < 0xF5)


def undo(text: str, codec: str) -> str:
    """Each image of a valid UTF-8 sequence in text replaced by its character; the rest stays."""
    if leads(codec).isdisjoint(text):
        return text
    return sequence(codec).sub(_Back(codec), text)


class _Back:
    """A match of sequence() → its character, or itself where the bytes are no UTF-8; remembers what it has seen."""

    seen: dict[str, dict[str, str]] = {}

    def __init__(self, codec: str):
        self.codec, self.known = codec, self.seen.setdefault(codec, {})

    def __call__(self, m: regex.Match) -> str:
        s = m.group()
        if (c := self.known.get(s)) is None:
            try:
                c = s if "�" in s else bytes(byte_of(self.codec)[x] for x in s).decode("utf-8")
            except UnicodeDecodeError:
                c = s
            if len(self.known) < 100_000:
                self.known[s] = c
        return c
