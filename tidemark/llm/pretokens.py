"""Pre-tokens of byte-level BPE: the public pattern, compiled for ``re``."""

from __future__ import annotations

import functools
import re
import sys

import public_tokenizers
import tiktoken

#: White space as Unicode defines it; ``re`` itself would add U+001C to U+001F.
_SPACE = r"\t-\r \x85\xa0  -     　"


def _members(major: str) -> str:
    """All code points of one major category, in order, as the tokenizer libraries see them.

    They follow another version of Unicode than Python and its ``regex`` do, so
    the library is asked which single characters match; each byte is a token.
    """
    every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    single = {bytes([b]): b for b in range(256)}
    found = tiktoken.Encoding(major, pat_str=rf"\p{{{major}}}", mergeable_ranks=single, special_tokens={})
    return bytes(found.encode_ordinary(every)).decode()


_spans: dict[str, list[tuple[int, int]]] = {}


def character_spans() -> dict[str, list[tuple[int, int]]]:
    """Ranges of letters and numbers. Asked for once, on the driver; workers are told by ``use_spans``."""
    for major in ("L", "N"):
        if major not in _spans:
            found: list[tuple[int, int]] = []
            for c in map(ord, _members(major)):
                if found and found[-1][1] == c - 1:
                    found[-1] = (found[-1][0], c)
                else:
                    found.append((c, c))
            _spans[major] = found
    return dict(_spans)


def use_spans(spans: dict[str, list[tuple[int, int]]]) -> None:
    _spans.update(spans)


def _ranges(major: str, top: int) -> str:
    """Character-class ranges of the code points up to ``top`` in one major category."""
    spans = [(a, min(b, top)) for a, b in character_spans()[major] if a <= top]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)


@functools.cache
def pattern(top: int = sys.maxunicode) -> re.Pattern[str]:
    """The public pattern with its Unicode classes written out for ``re``.

    Only the order differs: no contraction starts with a blank, a letter or a
    number, so the two commonest branches may come first. ``top`` leaves out
    code points that a text cannot have; ``re`` looks up the first 65,536 in a
    table, but tries the ranges beyond them one by one.
    """
    letter, number = _ranges("L", top), _ranges("N", top)
    contractions, last = public_tokenizers.PATTERN.split(r"| ?\p{L}+| ?\p{N}+|")
    rest = last.replace(r"\S", f"[^{_SPACE}]").replace(r"[^\s\p{L}\p{N}]", f"[^{_SPACE}{letter}{number}]")
    return re.compile(f" ?[{letter}]+| ?[{number}]+|{contractions}|" + rest.replace(r"\s", f"[{_SPACE}]"))


def pattern_for(text: str) -> re.Pattern[str]:
    """The fastest of the patterns that treat ``text`` alike."""
    if text.isascii():
        return pattern(0x7F)
    return pattern(0xFFFF) if len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text) else pattern()
