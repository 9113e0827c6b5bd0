"""Words of a text: runs of letters, digits and underscores of any script."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]+"
NOT_WORD = r"[^\p{L}\p{N}_]+"


def words(text: Column, min_length: int = 1) -> Column:
    """Lower-case words of at least ``min_length`` characters, in order."""
    parts = F.split(F.lower(text), NOT_WORD)
    return F.filter(parts, lambda w: F.length(w) >= min_length)


def letters(text: Column) -> Column:
    return F.regexp_replace(text, NOT_WORD, "")


# white space of any script, as text is split where words are kept as written
SPACE = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]+"


def raw_tokens(text: Column) -> Column:
    """Tokens between white space, case and punctuation kept."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")
