"""Texts cut where a byte-level pre-tokenizer cuts them anyway.

Such a pre-tokenizer starts a new pre-token at every blank before a character
that is no white space, whatever stands around it. So a text may be cut there,
equal pieces handled once, and the results put together; they are those of the
whole text. Pieces repeat as words do, which is what makes this fast.
"""

from __future__ import annotations

import re

import regex

_BLANK_BEFORE_SPACE = re.compile(r" (?:\s|\Z)")

#: Pieces and pre-tokens kept per Python worker, and the longest kept: memory,
#: not results, depends on them.
KEPT_PIECES = 300_000
KEPT_TOKENS = 500_000
LONGEST = 48

#: Fixed values of byte-level BPE: its pre-tokens, with white space as Unicode's property ...
_SPACE = r"\t-\r\x20\x85\xa0  -     　"
PRETOKEN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)

#: The same for texts without a character after U+024F, where the classes are few: this is quicker.
_LATIN, _DIGIT, _GAP = "A-Za-z\xaa\xb5\xbaÀ-ÖØ-öø-\u024f", "0-9²³¹¼-¾", r"\t-\r\x20\x85\xa0"
_LATIN_PRETOKEN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[{_DIGIT}]+| ?[^{_GAP}{_LATIN}{_DIGIT}]+|[{_GAP}]+(?![^{_GAP}])|[{_GAP}]+"
)


def pretokens(text: str) -> list[str]:
    if text.isascii() or max(text) < "\u0250":
        return _LATIN_PRETOKEN.findall(text)
    return PRETOKEN.findall(text)


def byte_letters() -> list[str]:
    """... and the letter of each byte in its vocabulary: itself if it is visible, else one after U+0100."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = (chr(256 + n) for n in range(256))
    return [chr(b) if b in seen else next(hidden) for b in range(256)]


def special_pattern(strings: list[str]) -> regex.Pattern | None:
    """Splits a text at special strings: every second part is one."""
    longest_first = sorted(strings, key=len, reverse=True)
    return regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if strings else None


def cut(text: str) -> list[str]:
    """The pieces, without the blank that every piece but the first begins with."""
    parts = text.split(" ")
    if _BLANK_BEFORE_SPACE.search(text) is None:
        return parts
    out = parts[:1]
    for part in parts[1:]:
        if part and not part[0].isspace():
            out.append(part)
        else:
            out[-1] += " " + part
    return out
