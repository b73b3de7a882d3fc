"""Column expressions on text: whitespace, sentences, share of a script, hashing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points treated as white space, as members of a regex class.
# Spelled out because Java's \s is ASCII-only and (?U)\s leaves out U+001C-001F.
_LOW = r"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0"
_HIGH = r"\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WHITESPACE = f"{_LOW} {_HIGH}"

# Marks that end a sentence when white space follows.
SENTENCE_MARKS = "።.!?፧"

# The Ethiopic blocks, and a Latin class for other corpora.
ETHIOPIC = r"\x{1200}-\x{137f}\x{1380}-\x{139f}\x{2d80}-\x{2ddf}\x{ab00}-\x{ab2f}"
LATIN = "A-Za-z"

MIN_CHARS = 20
MIN_SCRIPT_RATIO = 0.40

# Only runs that are not already one plain space need replacing, so ordinary
# text passes through without a match per word. The rare high characters sit
# behind one range test, and the low ones are single characters, which Java
# looks up in a bitmap; a class of many ranges tests them one after the other.
# The possessive loop keeps long runs off the stack.
_WIDE = rf"(?=[\x{{1680}}-\x{{3000}}])[{_HIGH}]"
_RUN = f"(?:[{_LOW}]|{_WIDE}| (?=[{WHITESPACE}]))(?:[{_LOW} ]|{_WIDE})*+"


def normalize_text(text: Column) -> Column:
    """White-space runs become one space; none remains at either end."""
    return F.trim(F.regexp_replace(text, _RUN, " "))


def split_sentences(text: Column) -> Column:
    """Array of normalized sentences in text order; the end mark stays with its sentence."""
    parts = F.split(normalize_text(text), f"(?<=[{SENTENCE_MARKS}]) ", -1)
    # After normalizing, a part is empty only if the whole text is.
    return F.array_remove(parts, "")


def _count_chars(text: Column, chars: str) -> Column:
    """Characters that match: what is gone once runs of them are deleted.

    Deleting the others instead would need a negated class, several times
    slower in Java where the class has more than one range.
    """
    return F.length(text) - F.length(F.regexp_replace(text, f"{chars}+", ""))


def script_ratio(text: Column, script: str = ETHIOPIC) -> Column:
    """Characters in the ``script`` class per letter; 0.0 where there is no letter.

    Punctuation, digits and marks of the script count above the line only, so
    the value can exceed 1.
    """
    ratio = F.try_divide(_count_chars(text, f"[{script}]"), _count_chars(text, r"\p{L}"))
    return F.coalesce(ratio, F.lit(0.0))


def long_enough(text: Column, min_chars: int = MIN_CHARS) -> Column:
    """True where the text has at least ``min_chars`` code points."""
    return F.length(text) >= F.lit(min_chars)


def in_script(
    text: Column, script: str = ETHIOPIC, min_ratio: float = MIN_SCRIPT_RATIO
) -> Column:
    """True where :func:`script_ratio` reaches ``min_ratio``."""
    return script_ratio(text, script) >= F.lit(min_ratio)


def sentence_hash(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes, in hex."""
    return F.sha2(text, 256)
