"""The character forms of lookalike.py for Python code inside Arrow batches."""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Callable

import numpy as np

from larkspur.llm.lookalike import INVISIBLE, LIGATURES, LOOKALIKES, compatibility


@functools.cache
def invisible() -> frozenset[int]:
    """The code points of INVISIBLE's ranges."""
    out: set[int] = set()
    for part in INVISIBLE.replace("\\x{", " ").replace("}", "").split():
        if part.startswith("-"):
            continue
        out.add(int(part.rstrip("-"), 16))
    ends = INVISIBLE.replace("\\x{", "").split("}")
    for a, b in zip(ends, ends[1:], strict=False):
        if b.startswith("-"):
            out.update(range(int(a.lstrip("-"), 16), int(b[1:], 16) + 1))
    return frozenset(out)


@functools.cache
def plain_table() -> dict[int, str | None]:
    a, b = compatibility()
    return {ord(x): y for x, y in zip(a, b, strict=True)} | {ord(k): v for k, v in LIGATURES.items()} | dict.fromkeys(invisible())


@functools.cache
def latin_table() -> dict[int, str]:
    return {ord(x): y for a, b in LOOKALIKES for x, y in zip(a, b, strict=True)}


@functools.cache
def _finders() -> tuple:
    """Searches for characters that plain() changes, and for Cyrillic letters that don't look Latin."""
    points = sorted(plain_table())
    ranges, a = [], points[0]
    for x, y in zip(points, [*points[1:], None], strict=True):
        if y != x + 1:
            ranges.append(re.escape(chr(a)) + "-" + re.escape(chr(x)))
            a = y
    own = "".join(chr(c) for c in range(0x400, 0x500) if c not in latin_table())
    return re.compile("[" + "".join(ranges) + "]"), re.compile("[\u0300-\u036f\u3099\u309a\u212a]"), re.compile("[\u0370-\u058f\u13a0-\u13ff\u1d26\u2160-\u217f\ua4d0-\ua4ff\u0131\u0237\u0251-\u0269\u028f]"), re.compile(f"[{own}]")


def changes(text: str) -> bool:
    """Whether a text has characters that have another plain form or may look like a Latin letter."""
    changed, _, other, _ = _finders()
    return bool(changed.search(text) or other.search(text))


def codes(text: str) -> np.ndarray:
    """The code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def written(points: np.ndarray) -> str:
    """The text of code points."""
    return points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


class Kinds:
    """Which of some tests of single characters hold, as bits in the tests' order, for arrays of code points; each code point is tested once."""

    def __init__(self, *tests: Callable[[str], object]):
        self.tests, self.unknown = tests, 1 << len(tests)
        self.held = np.full(0x110000, self.unknown, np.uint16)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        bits = self.held[points]
        if len(new := np.unique(points[bits == self.unknown])):
            self.held[new] = [sum(bool(f(chr(c))) << k for k, f in enumerate(self.tests)) for c in new.tolist()]
            bits = self.held[points]
        return bits


def may_change(c: str) -> bool:
    """Whether plain() may change a text with this character in it; it leaves one without such as it is."""
    changed, marks, other, _ = _finders()
    return bool(changed.search(c) or marks.search(c) or other.search(c))


def is_cyrillic(text: str) -> bool:
    """Whether a text has Cyrillic letters that don't look Latin: then the others are Cyrillic too."""
    return bool(_finders()[3].search(text))


def plain(text: str, latin: bool = True) -> str:
    """text without invisible characters, in plain width, composed, and with Latin look-alikes made Latin unless it is truly Cyrillic."""
    if text.isascii():
        return text
    changed, marks, other, cyrillic = _finders()
    if changed.search(text):
        text = unicodedata.normalize("NFC", text.translate(plain_table()))
    elif marks.search(text):
        text = unicodedata.normalize("NFC", text)
    if latin and other.search(text) and not cyrillic.search(text):
        text = text.translate(latin_table())
    return text


@functools.cache
def _runs() -> re.Pattern:
    """Runs of ASCII characters that plain() leaves as they are, and other characters."""
    own = "".join(re.escape(chr(c)) for c in range(128) if c not in plain_table())
    return re.compile(f"[{own}]+|[^{own}]")


def origins(text: str) -> list[int]:
    """For each character of plain(text) the place in text of the first one it was made from, and the length of text at the end."""
    table, out, held, at = plain_table(), [], "", 0
    for m in _runs().finditer(text):
        i, end = m.span()
        c = m[0]
        if c <= "\x7f" or end - i > 1:
            # Nothing is composed with what stands before an ASCII character.
            out += [at] * len(held if held.isascii() else unicodedata.normalize("NFC", held))
            out += range(i, end - 1)
            held, at = c[-1], end - 1
            continue
        for x in table.get(ord(c), c) or "":
            if held and x > "\x7f" and (unicodedata.combining(x) or unicodedata.normalize("NFC", held + x) != unicodedata.normalize("NFC", held) + x):
                held += x
                continue
            out += [at] * len(held if held.isascii() else unicodedata.normalize("NFC", held))
            held, at = x, i
    return [*out, *[at] * len(unicodedata.normalize("NFC", held)), len(text)]
