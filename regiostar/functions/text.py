"""Text clean-up as column expressions."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Python's str.strip sees it: Unicode white space and the four separators.
SPACE_CLASS = r"[\s\x1c-\x1f]"
_SPACES = "".join(chr(code) for code in range(sys.maxunicode + 1) if chr(code).isspace())

# Korean syllables decompose by arithmetic: leading consonant, vowel and, unless the remainder is 0, a final consonant.
_SYLLABLES = (0xAC00, 0xD7A3)
_LEADS = "".join(chr(0x1100 + i) for i in range(19))
_VOWELS = "".join(chr(0x1161 + i) for i in range(21))
_FINALS = "".join(chr(0x11A8 + i) for i in range(27))


def strip(col: Column) -> Column:
    """Drop white space of any kind at both ends (a plain ``trim`` would only drop blanks).

    Trimming looks up the first and last character among all spaces, which costs ten times as much as two comparisons:
    texts that begin and end with a character below the next space, in code point order, stay as they are.
    """
    return F.when(_begins_solid(col) & _begins_solid(F.right(col, F.lit(1))), col).otherwise(F.btrim(col, F.lit(_SPACES)))


def _begins_solid(col: Column) -> Column:
    """Whether the first character lies between the spaces up to U+00A0, or after them and before U+1680."""
    return ((col >= "!") & (col < "\x85")) | ((col >= "\xa1") & (col < "\u1680"))


def standardise(col: Column) -> Column:
    return F.upper(strip(col))


def drop_thousands(col: Column) -> Column:
    return F.replace(col, F.lit(","), F.lit(""))


@lru_cache(maxsize=1)
def _accent_tables() -> tuple[str, str, dict[str, str]]:
    """Characters with one base character and those bases, and the few others with several.

    ``translate`` deletes characters beyond the end of the second text, so the marks come last.
    """
    accented, bases, marks, several = [], [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        parts = unicodedata.normalize("NFD", char)
        plain = "".join(c for c in parts if unicodedata.category(c) != "Mn")
        if plain == char or _SYLLABLES[0] <= code <= _SYLLABLES[1]:
            continue
        if not plain:
            marks.append(char)
        elif len(plain) == 1:
            accented.append(char)
            bases.append(plain)
        else:
            several[char] = plain
    return "".join(accented) + "".join(marks), "".join(bases), several


def _decomposed(char: Column, several: dict[str, str]) -> Column:
    index = F.ascii(char) - _SYLLABLES[0]
    syllable = F.concat(
        F.substring(F.lit(_LEADS), F.floor(index / 588).cast("int") + 1, F.lit(1)),
        F.substring(F.lit(_VOWELS), F.floor(index % 588 / 28).cast("int") + 1, F.lit(1)),
        F.when(index % 28 > 0, F.substring(F.lit(_FINALS), index % 28, F.lit(1))).otherwise(""),
    )
    others = F.map_from_arrays(F.lit(list(several)), F.lit(list(several.values())))
    is_syllable = char.between(chr(_SYLLABLES[0]), chr(_SYLLABLES[1]))
    return F.when(is_syllable, syllable).otherwise(F.coalesce(others[char], char))


def strip_accents(col: Column) -> Column:
    """Decompose and drop combining marks, for comparison only.

    ``translate`` handles every character with a single base. Texts with characters of several bases, such as Korean
    syllables, are first taken apart character by character.
    """
    accented, bases, several = _accent_tables()
    with_several = f"[{chr(_SYLLABLES[0])}-{chr(_SYLLABLES[1])}{''.join(several)}]"
    apart = F.array_join(F.transform(F.split(col, ""), lambda c: _decomposed(c, several)), "")
    return F.translate(F.when(col.rlike(with_several), apart).otherwise(col), accented, bases)
