"""Pre-tokens: splitting by a tokenizer's pattern, and a bounded memory of their encodings."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain

import regex

# The code points of Unicode's White_Space property, which the tokenizer
# libraries mean by \s. Python's own \s has four control characters more.
WHITE_SPACE = r"\t-\r \x85\xa0  -     　"
# Within printable ASCII, tab, line ends and U+00A1 to U+02C1 without the
# numbers among them, these are all letters, digits and white space there are.
PLAIN_LETTERS = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ˁ"
PLAIN_DIGITS = "0-9"
PLAIN_SPACE = r"\t\n\r "
_NOT_PLAIN = re.compile(r"[^\t\n\r -~\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-ˁ]")


def _with_classes(pattern: str, classes: dict[str, str]) -> str:
    r"""``pattern`` with the given meanings of \s and so on, in and out of brackets."""
    out, i, inside = [], 0, False
    while i < len(pattern):
        name = next((c for c in (r"\p{L}", r"\p{N}", r"\s", r"\S") if pattern.startswith(c, i)), None)
        if name == r"\S":
            out.append(f"[^{classes[r'\s']}]")
        elif name in classes:
            out.append(classes[name] if inside else f"[{classes[name]}]")
        elif name:
            out.append(name)
        elif pattern[i] == "\\":
            name = pattern[i : i + 2]
            out.append(name)
        else:
            inside = pattern[i] == "[" or inside and pattern[i] != "]"
            name = pattern[i]
            out.append(name)
        i += len(name)
    return "".join(out)


class Splitter:
    r"""All matches of a tokenizer's pattern of \p{L}, \p{N} and \s, in order.

    Texts of Latin letters, digits and common signs, where the classes come down to a
    few ranges, go through Python's faster engine; all others through ``regex``.
    """

    def __init__(self, pattern: str):
        self._full = regex.compile(_with_classes(pattern, {r"\s": WHITE_SPACE})).findall
        plain = {r"\s": PLAIN_SPACE, r"\p{L}": PLAIN_LETTERS, r"\p{N}": PLAIN_DIGITS}
        self._plain = re.compile(_with_classes(pattern, plain)).findall

    def __call__(self, text: str) -> list[str]:
        return self._full(text) if _NOT_PLAIN.search(text) else self._plain(text)


class PieceMemory:
    """Encodings of pre-tokens seen so far, each computed once.

    ``encode`` takes the distinct new pieces of a block of texts at a time. The memory
    is emptied when it would pass ``most`` pieces, so it stays bounded on any input.
    """

    def __init__(self, split: Callable[[str], list[str]], encode: Callable[[list[str]], list], most: int = 500_000):
        self.split, self.encode, self.most = split, encode, most
        self.known: dict[str, object] = {}

    def values(self, texts: list[str]) -> Iterator[list]:
        """For each text the encodings of its pieces in order."""
        pieces = [self.split(text) for text in texts]
        wanted = set(chain.from_iterable(pieces))
        new = wanted - self.known.keys()
        if len(self.known) + len(new) > self.most:
            self.known.clear()
            new = wanted
        order = list(new)
        self.known.update(zip(order, self.encode(order)))
        get = self.known.__getitem__
        for own in pieces:
            yield list(map(get, own))
