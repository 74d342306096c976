"""Benchmark decontamination: a prefix-filtered set join with exact verification, in built-in functions only.

A window is ``window`` consecutive item words (or a shorter item whole). Since
a document must hold all of a window, the necessary prefix of the window's
shingles in order of rarity is its rarest one alone. That shingle's place in
the window and in the document fix where the window would stand (positional
bound) and whether the document reaches that far (length bound); the words
there are then compared one by one.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import materialize

#: What separates words: ASCII but for digits and letters.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before A-Z become lower case.
ANY_CASE_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SHINGLE = 3
#: Most bytes of benchmark rows (shingles, windows with their words) that are sent to all executors; beyond, both sides are dealt by shingle.
BROADCAST_BYTES = 200_000_000


def parts_of(text: Column) -> Column:
    """What stands between the gaps of a text, A-Z in lower case; null is empty."""
    return F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase), GAP)


def trimmed(parts: Column) -> Column:
    """A gap at either end of the text leaves an empty first or last part."""
    first = F.when(F.element_at(parts, 1) == "", 1).otherwise(0)
    last = F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return F.slice(parts, first + 1, F.size(parts) - first - last)


def shingles(words: str, size: int) -> Column:
    """A 64-bit key for each run of ``size`` words; it nominates, the words decide."""
    keyed = lambda i: F.xxhash64(*(F.element_at(F.col(words), i + k) for k in range(size)))
    return F.when(F.size(words) >= size, F.transform(F.sequence(F.lit(1), F.size(words) - (size - 1)), keyed)).otherwise(F.array().cast("array<bigint>"))


def near(df: DataFrame, n_bytes: int) -> DataFrame:
    return F.broadcast(df) if n_bytes <= BROADCAST_BYTES else df


def item_windows(items: DataFrame, window: int, size: int) -> DataFrame:
    """``item, iwords, m, s, q, token``: each window (m words from s) with each of its shingles (at q, from 0), of items that suit ``size``."""
    n = F.size("iwords")
    suited = items.where(n >= SHINGLE) if size == SHINGLE else items.where((n > 0) & (n < SHINGLE))
    spans = suited.withColumn("m", F.least(n, F.lit(window))).withColumn("s", F.explode(F.sequence(F.lit(0), n - F.col("m"))))
    tokens = spans.withColumn("tokens", shingles("iwords", size))
    return tokens.select("item", "iwords", "m", "s", F.explode(F.sequence(F.col("s"), F.col("s") + F.col("m") - size)).alias("q"), "tokens").withColumn("token", F.element_at("tokens", F.col("q") + 1)).drop("tokens")


def hit_windows(docs: DataFrame, items: DataFrame, window: int, size: int) -> DataFrame | None:
    """``doc_id, text_key, item, at, m``: every occurrence of a window of an item that suits ``size``; None if no item does."""
    grams = materialize(item_windows(items, window, size), "windows")
    n_rows, n_bytes = grams.agg(F.count("*"), F.sum(64 + F.length(F.array_join("iwords", " ")) + 24 * F.size("iwords"))).first()
    if not n_rows:
        return None
    tokens = docs.select("doc_id", "text_key", "words", F.posexplode(shingles("words", size)).alias("p", "token"))
    known = grams.select("token").distinct()
    counts = tokens.select("token").join(near(known, 32 * n_rows), "token", "left_semi").groupBy("token").count()
    ranked = grams.join(near(materialize(counts, "counts"), 48 * n_rows), "token", "left")
    rarest = ranked.groupBy("item", "iwords", "m", "s").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token", "q")).alias("r")).where("r.n > 0")
    anchors = materialize(rarest.groupBy(F.col("r.token").alias("token"), "item", "iwords", "m", F.col("r.q").alias("q")).agg(F.sort_array(F.collect_list("s")).alias("ss")), "anchors")
    if n_bytes <= BROADCAST_BYTES:
        met = tokens.join(F.broadcast(anchors), "token")
    else:
        # Shuffled, a shingle goes without its document's words; only what meets a window gets them.
        met = tokens.drop("words").join(anchors, "token").withColumnsRenamed({"doc_id": "of", "text_key": "of_key"})
        words = docs.select("doc_id", "text_key", "words").dropDuplicates(["doc_id", "text_key"])
        met = words.join(met, words["doc_id"].eqNullSafe(met["of"]) & (words["text_key"] == met["of_key"])).drop("of", "of_key")
    begins = lambda s: F.col("p") - F.col("q") + s
    same = lambda s: (begins(s) >= 0) & (begins(s) + F.col("m") <= F.size("words")) & (F.slice("words", begins(s) + 1, F.col("m")) == F.slice("iwords", s + 1, F.col("m")))
    found = met.select("doc_id", "text_key", "item", "m", F.explode(F.transform(F.filter("ss", same), begins)).alias("at"))
    return found.select("doc_id", "text_key", "item", "at", "m")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document row: ``doc_id, text_key (xxhash64 of the text), n_words, n_hit, items (sorted strings), contaminated``.

    A document word is hit inside any occurrence of a window; ``items`` are
    those with occurring windows. Null and empty texts have no words, items
    without words no window; items without an id hit like others, under the
    empty string; an empty benchmark hits nothing. Equal rows give equal
    rows, and a null ``doc_id`` is a value like others. Very long texts are
    one row's array of words. Other columns are not read.
    """
    # Rows with equal ids and texts have equal hits; the two together name a document.
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).withColumn("text_key", F.xxhash64("text"))
    worded = base.select("doc_id", "text_key", parts_of(F.col("text")).alias("parts")).select("doc_id", "text_key", trimmed(F.col("parts")).alias("words"))
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), parts_of(F.col(item_text_col)).alias("parts"))
    items = materialize(items.select("item", trimmed(F.col("parts")).alias("iwords")), "items")
    found = [x for size in (SHINGLE, 1) if (x := hit_windows(worded, items, window, size)) is not None]
    counted = base.select("doc_id", "text_key", F.split("text", ANY_CASE_GAP).alias("parts")).select("doc_id", "text_key", F.size(trimmed(F.col("parts"))).cast("long").alias("n_words"))
    if not found:
        empty = F.array().cast("array<string>")
        return counted.select("doc_id", "text_key", "n_words", F.lit(0).cast("long").alias("n_hit"), empty.alias("items"), F.lit(False).alias("contaminated"))
    hits = found[0] if len(found) == 1 else found[0].unionAll(found[1])
    covered = F.size(F.array_distinct(F.flatten(F.transform(F.collect_set(F.struct("at", "m")), lambda x: F.sequence(x["at"], x["at"] + x["m"] - 1)))))
    by_doc = hits.groupBy("doc_id", "text_key").agg(covered.cast("long").alias("n_hit"), F.sort_array(F.collect_set("item")).alias("items"))
    by_doc = by_doc.select(F.col("doc_id").alias("hit_doc"), F.col("text_key").alias("hit_key"), "n_hit", "items")
    both = counted.join(by_doc, counted["doc_id"].eqNullSafe(by_doc["hit_doc"]) & (counted["text_key"] == by_doc["hit_key"]), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return both.select("doc_id", "text_key", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), (n_hit > 0).alias("contaminated"))
