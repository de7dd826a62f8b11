"""Word matching and highlighting."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Code points of scripts that put no spaces between words (fixed values).
UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF),
            (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]
# A letter or digit of the other scripts: their words end where none follows. Between
# letters of the scripts above every place may be a word's edge.
WORD = r"[\p{L}\p{N}&&[^" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in UNSPACED) + "]]"


def _bounded(word: str) -> str:
    """The word, with an edge wanted on each side that is of a spaced script."""
    def spaced(letter: str) -> bool:
        return not any(a <= ord(letter) <= b for a, b in UNSPACED)

    before = f"(?<!{WORD})" if spaced(word[0]) else ""
    after = f"(?!{WORD})" if spaced(word[-1]) else ""
    return before + re.escape(word) + after


def _pattern(query: str) -> str:
    words = [_bounded(w) for w in query.split()]
    if not words:
        raise ValueError("empty search text")
    return rf"(?iu)(?:{'|'.join(words)})"


# A run of letters and digits of the spaced scripts, or one sign of the others.
TERM = WORD + "+|[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in UNSPACED) + "]"


def terms_of(text: Column) -> Column:
    """The terms of a text in lower case, in order, with repeats."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def terms_of_query(query: str) -> list[list[str]]:
    """For each word of the query the terms a text that holds it must have; words without any have none."""
    unspaced = "".join(f"{chr(a)}-{chr(b)}" for a, b in UNSPACED)
    pattern = re.compile(rf"(?:(?![{unspaced}])[^\W_])+|[{unspaced}]")
    words = [pattern.findall(w.lower()) for w in query.split()]
    return [w for w in words if w]


def matches_any_word(text: Column, query: str) -> Column:
    """True where the text holds at least one of the query's words."""
    return text.rlike(_pattern(query))


def highlight(text: Column, query: str) -> Column:
    return F.regexp_replace(text, _pattern(query), "<em>$0</em>")
