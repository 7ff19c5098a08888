"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters with the Unicode White_Space property.
WHITESPACE = "".join(
    chr(code)
    for code in (
        0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680,
        0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)
# The information separators, which record contracts strip as well.
SEPARATORS = "\u001c\u001d\u001e\u001f"


def trimmed(text: Column) -> Column:
    """Strip Unicode white space at both ends (plain ``trim`` strips U+0020 only).

    For columns that are mostly clean: a text that begins and ends with visible
    ASCII is recognised by two byte comparisons, at a fraction of the cost of a
    search for every kind of blank.
    """
    clean = _starts_visible(text) & _starts_visible(F.reverse(text))
    return F.when(clean, text).otherwise(F.trim(text, F.lit(WHITESPACE)))


def stripped(text: Column) -> Column:
    """Strip white space and information separators at both ends."""
    return F.trim(text, F.lit(WHITESPACE + SEPARATORS))


def _starts_visible(text: Column) -> Column:
    return (text >= "!") & (text < "\x7f")


def blank(text: Column) -> Column:
    return F.length(stripped(text)) == 0
