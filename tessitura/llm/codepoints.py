"""Tests of whole Arrow columns of text, on their code points at once."""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa

PLANE = 0x10000


def points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, where each text begins, and the end); NULL counts as ''."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    u = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    first = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return u, first[offsets - offsets[0]]


def table(chars: str | None = None, test=None) -> np.ndarray:
    """A truth table of the basic plane, of given characters or of a test on the character."""
    out = np.zeros(PLANE, bool)
    if chars is not None:
        out[[ord(c) for c in chars]] = True
    else:
        out[:] = [test(chr(i)) for i in range(PLANE)]
    return out


def look(t: np.ndarray, u: np.ndarray, beyond: bool = False) -> np.ndarray:
    """The table's truth for each code point; ``beyond`` for those outside the basic plane."""
    out = t[np.minimum(u, PLANE - 1)]
    if len(u) and u.max() >= PLANE:
        out = np.where(u >= PLANE, beyond, out)
    return out


def any_in(flags: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Whether a text has a flagged code point."""
    at = np.flatnonzero(flags)
    return np.searchsorted(at, begin[1:]) > np.searchsorted(at, begin[:-1])


def first_in(flags: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Position of a text's first flagged code point, or its end."""
    at = np.append(np.flatnonzero(flags), np.iinfo(np.int64).max)
    return np.minimum(at[np.searchsorted(at, begin[:-1])], begin[1:])


def last_in(flags: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Position of a text's last flagged code point, or one before its begin."""
    at = np.insert(np.flatnonzero(flags), 0, -1)
    return np.maximum(at[np.searchsorted(at, begin[1:]) - 1], begin[:-1] - 1)


def category(prefix: str) -> np.ndarray:
    """Truth table of the general categories that begin with prefix."""
    return table(test=lambda c: unicodedata.category(c).startswith(prefix))
