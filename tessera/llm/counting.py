"""Words between blanks, counted with built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What stands between words.
BLANKS, BLANK = " \t\n\x0b\x0c\r", r"[\x20\x09-\x0D]"


def n_words(text: Column) -> Column:
    """Number of runs of other characters: each, with the blanks after it, becomes one letter, so no list of words is made."""
    return F.char_length(F.regexp_replace(F.ltrim(text, F.lit(BLANKS)), F.lit(rf"[^\x20\x09-\x0D]++{BLANK}*+"), F.lit("x"))).cast("long")
