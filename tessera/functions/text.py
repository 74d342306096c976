"""Path, name and keyword expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rank bands and the label from each upper rank on.
RANK_BANDS = ((5000, "Top 5k"), (10000, "5k-10k"), (20000, "10k-20k"), (30000, "20k-30k"), (40000, "30k-40k"), (50000, "40k-50k"), (60000, "50k-60k"))
LAST_BAND = ">60k"
# Media types by extension.
MIME = (("png", "image/png"), ("gif", "image/gif"), ("webp", "image/webp"), ("bmp", "image/bmp"))


def band_label(rank: Column, bands: tuple = RANK_BANDS, last: str = LAST_BAND) -> Column:
    out = None
    for top, label in bands:
        out = F.when(rank <= top, label) if out is None else out.when(rank <= top, label)
    return out.otherwise(last)


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def suffix(path: Column) -> Column:
    return F.regexp_extract(file_name(path), r"(\.[^.]*)$", 1)


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def parent(path: Column) -> Column:
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, "/[^/]*$", "")).otherwise("")


def mime_type(path: Column) -> Column:
    """By extension; jpeg where it is unknown."""
    end, out = F.lower(suffix(path)), None
    for ext, kind in MIME:
        out = F.when(end == "." + ext, kind) if out is None else out.when(end == "." + ext, kind)
    return out.otherwise("image/jpeg")


def data_url(path: Column, content: Column) -> Column:
    return F.concat(F.lit("data:"), mime_type(path), F.lit(";base64,"), F.replace(F.base64(content), F.lit("\r\n"), F.lit("")))


def numbered_name(index: Column, name: Column) -> Column:
    return F.format_string("%06d_%s", index, name)


def column_name(prompt: Column) -> Column:
    return F.replace(prompt, F.lit(" "), F.lit("_"))


def split_name(path: Column, otherwise: str = "data") -> Column:
    """train, val or test, whichever the stem holds first in that order."""
    low = F.lower(stem(path))
    return F.when(low.contains("train"), "train").when(low.contains("val"), "val").when(low.contains("test"), "test").otherwise(otherwise)


def affixed(text: Column, prefix: str, suffix_: str, only: str | None = None) -> Column:
    """Prefix and suffix around a text, or only where it equals ``only`` in lower case, trimmed."""
    full = F.concat(F.lit(prefix), text, F.lit(suffix_))
    return full if only is None else F.when(F.lower(F.trim(text)) == only.strip().lower(), full).otherwise(text)


def preview(text: Column, n: int = 80) -> Column:
    return F.when(F.char_length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(text)


def sized_url(base: Column, width: Column, limit: float) -> Column:
    """The full-size address where the width is unknown (null or NaN) or small enough, else the limited one."""
    return F.when(width.isNull() | F.isnan(width) | (width <= limit), F.concat(base, F.lit("/full/full/0/default.jpg"))).otherwise(F.concat(base, F.lit(f"/full/{limit:.0f},/0/default.jpg")))
