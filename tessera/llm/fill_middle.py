"""Fill-in-middle rearrangement by one counted-quantifier match a row, with built-in functions only.

``regexp_count`` gives a text's number of units; a pattern of its own takes
the first a units, the next b - a and the rest as three groups of one match.
The counted groups are possessive, which Java's engine runs as a loop: neither
long texts nor large counts use its stack, and nothing is tried twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the format, and what counts as a unit.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = "(?:[A-Za-z]++|[^A-Za-z])"
#: Units of one match of ``regexp_count``, which holds what it matches: a text is held about once, however many units it has.
BLOCK = 1024


def n_units(text: Column) -> Column:
    """Whole blocks of units from the start on, then the units after them."""
    block = f"{UNIT}{{{BLOCK}}}+"
    rest = F.regexp_replace(text, F.lit(rf"\A(?:{block})*+"), F.lit(""))
    return (F.regexp_count(text, F.lit(rf"\G{block}")) * BLOCK + F.regexp_count(rest, F.lit(UNIT))).cast("long")


def draw(doc_id: Column, k: int) -> Column:
    """The k-th 8-digit group, from 0, of the SHA-256 of ``1:`` and the decimal id; no id counts as no digits."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def restored(output: Column, form: Column) -> Column:
    """The text again, from the output and its form alone: no text with a mark in it is rearranged, so each mark stands once."""
    psm = F.regexp_replace(output, F.lit(rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*+)\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*+)\z"), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(df: DataFrame, rate: int = 90, spm_rate: int = 20) -> DataFrame:
    """``doc_id, n, form, output, prefix_chars, middle_chars`` of each row of ``doc_id, text``.

    ``rate`` in a hundred texts are cut at two units drawn from the id, and of
    those ``spm_rate`` in a hundred begin with the suffix. Null text is empty;
    an empty text, or one that holds a mark, stays plain. Rows of one id are
    cut at their own units by the same draws; a null id draws as one without
    digits. Other columns don't matter. No row meets another: no shuffle.
    """
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    h = [draw(F.col("doc_id"), k) for k in range(4)]
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("text") == "") | marked | (h[2] % 100 >= rate)
    form = F.when(plain, "plain").when(h[3] % 100 < spm_rate, "spm").otherwise("psm")
    cut = docs.withColumn("n", n_units(F.col("text"))).withColumn("form", form)
    first, second = h[0] % (F.col("n") + 1), h[1] % (F.col("n") + 1)
    cut = cut.withColumn("a", F.least(first, second)).withColumn("b", F.greatest(first, second))
    groups = F.concat(F.lit(rf"(?s)\A({UNIT}{{"), F.col("a"), F.lit(f"}}+)({UNIT}{{"), F.col("b") - F.col("a"), F.lit(r"}+)(.*+)\z"))
    order = F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    cut = cut.withColumn("output", F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", groups, order)))
    at = {mark: F.instr("output", F.lit(mark)) for mark in (PREFIX, SUFFIX, MIDDLE)}
    prefix = F.when(F.col("form") == "psm", at[SUFFIX] - len(PREFIX) - 1).when(F.col("form") == "spm", at[MIDDLE] - at[PREFIX] - len(PREFIX))
    middle = F.when(F.col("form") != "plain", F.char_length("output") - at[MIDDLE] + 1 - len(MIDDLE))
    return cut.select("doc_id", "n", "form", "output", prefix.cast("long").alias("prefix_chars"), middle.cast("long").alias("middle_chars"))
