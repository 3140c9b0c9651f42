"""Words of a text for matching: without typography, case, accents, line layout
and bracketed remarks."""

from __future__ import annotations

import re
import unicodedata

_BRACKET = re.compile(r"[()\[\]{}]")
_CLOSES = {")": "(", "]": "[", "}": "{"}
_HYPHEN_BREAK = re.compile(r"(?<=[^\W\d_])[-‐­]\s*\n\s*(?=[^\W\d_])|­")
_WORD = re.compile(r"[^\W_]+")
_MARKS = re.compile(r"[̀-ͯ]+")
#: Letters that keep no accent when decomposed, and common typography, which is
#: made plain so that most texts become ASCII.
_PLAIN = (
    ("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("ø", "o"), ("đ", "d"), ("ł", "l"), ("’", "'"), ("‘", "'"), ("ʼ", "'"),
    ("“", " "), ("”", " "), ("„", " "), ("«", " "), ("»", " "), ("–", " "), ("—", " "), ("…", " "), ("•", " "), ("·", " "),
)
#: For ASCII: lower case, and a blank for all that is neither letter nor digit.
_ASCII = bytes(ord(chr(i).lower()) if chr(i).isalnum() and i < 128 else 32 for i in range(256))


def without_remarks(text: str) -> str:
    """The text without bracketed remarks, of any length and nested in any way.
    A bracket that is never closed, or closes nothing, is no remark. One scan
    over the brackets."""
    opened: list[tuple[str, int]] = []
    cuts: list[tuple[int, int]] = []
    for m in _BRACKET.finditer(text):
        c = m.group()
        if c in "([{":
            opened.append((c, m.start()))
            continue
        depth = len(opened) - 1
        while depth >= 0 and opened[depth][0] != _CLOSES[c]:
            depth -= 1
        if depth >= 0:
            start = opened[depth][1]
            del opened[depth:]
            while cuts and cuts[-1][0] > start:
                cuts.pop()
            cuts.append((start, m.end()))
    if not cuts:
        return text
    out, at = [], 0
    for a, b in cuts:
        out += [text[at:a], " "]
        at = b
    return "".join([*out, text[at:]])


def plain(text: str) -> str:
    """Without accents and bracketed remarks, in lower case if not ASCII; words cut
    at a line's end by a hyphen are joined."""
    if "(" in text or "[" in text or "{" in text:
        text = without_remarks(text)
    if "-\n" in text or "­" in text or "‐" in text:
        text = _HYPHEN_BREAK.sub("", text)
    if text.isascii():
        return text
    text = text.casefold()
    for a, b in _PLAIN:
        if a in text:
            text = text.replace(a, b)
    return text if text.isascii() else _MARKS.sub("", unicodedata.normalize("NFKD", text)).casefold()


def words(text: str | None) -> list[str]:
    """See the module's text; [] for null."""
    if not text:
        return []
    text = plain(text)
    return text.encode("ascii").translate(_ASCII).decode("ascii").split() if text.isascii() else _WORD.findall(text)


def readings(text: str | None, long: int = 100) -> list[list[str]]:
    """The words without bracketed remarks and, where a remark has ``long``
    characters or more, so that it may itself hold a passage or run from a stray
    bracket to another, also the words with all of them."""
    if not text:
        return []
    out = [words(text)]
    if any(c in text for c in "([{") and len(text) - len(without_remarks(text)) >= long:
        out.append(words(_BRACKET.sub(" ", text)))
    return out
