"""Stretches of a text that tokenizers encode independently of what is around them.

A unit begins at a space or a line feed after a character that is no white space by
anyone's reading. The splitting pattern of byte-level BPE always has a boundary
there: no alternative goes from a character that is not white space on to one that is, and
what looks ahead looks at the unit's own characters. A sentencepiece model has one there if
no piece holds a space or a line feed behind another character.
"""

from __future__ import annotations

import re

#: Latin letters (fixed values): their classes are the same in every version.
LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
#: Marks at which a word of Latin letters ends for the splitting pattern, whatever comes next.
MARKS = ".,;:!?"
#: Everything that some Unicode version or library counts as white space (fixed values), but for space and line feed.
_ODD = "\t\x0b\x0c\r\x1c-\x1f\x85\xa0 ᠎ -‍    ⁠　﻿"
_UNIT = re.compile(rf"(?:[ \n][ \n{_ODD}]*)?[^ \n{_ODD}]*(?:[{_ODD}][ \n{_ODD}]*[^ \n{_ODD}]*)*")
_SHORT = re.compile(rf"[ \n][{LATIN}]+(?=[ \n{MARKS}])|{_UNIT.pattern}")


def units(text: str) -> list[str]:
    """The units of ``text`` in order; joined they are the text. The last one may be empty."""
    return _UNIT.findall(text)


def short_units(text: str) -> list[str]:
    """As ``units``, but also cut in front of a mark behind a word, for models that have no piece of a letter with a mark behind it."""
    return _SHORT.findall(text)
