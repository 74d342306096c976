"""Masks and images made from the documents' own bytes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import masks
from tessera.operators import degrade
from tessera.plans.common import query, r6, table


def run_lengths(spark, sf_dir):
    """An 8 by 16 mask from a digest's bits, as runs built by built-in functions: bits, change points, differences."""
    bits = F.concat_ws("", F.transform(F.split(F.md5(F.coalesce("text", F.lit("")).cast("binary")), ""), lambda c: F.lpad(F.conv(c, 16, 2), 4, "0")))
    d = table(spark, sf_dir, "documents").select("doc_id", F.split(bits, "").alias("bits"))
    edges = F.filter(F.sequence(F.lit(0), F.lit(128)), lambda i: F.when(i == 128, True).when(i == 0, F.col("bits")[0] == "1").otherwise(F.col("bits")[i] != F.element_at("bits", i)))
    starts = F.when(F.col("bits")[0] == "1", F.concat(F.array(F.lit(0)), F.slice(edges, 2, 200))).otherwise(edges)
    return d.withColumn("ends", starts).select("doc_id", F.transform("ends", lambda e, i: e - F.when(i == 0, F.lit(0)).otherwise(F.col("ends")[i - 1])).alias("counts"))


@query("select doc_id, bit_count(('0x' || md5(coalesce(text, ''))[1:15])::bigint)::bigint + bit_count(('0x' || md5(coalesce(text, ''))[16:30])::bigint)::bigint + bit_count(('0x' || md5(coalesce(text, ''))[31:32])::bigint)::bigint as area from documents")
def f11_mask_area(spark, sf_dir):
    """Area from the runs, without decoding a mask."""
    return run_lengths(spark, sf_dir).select("doc_id", masks.area(F.col("counts")).alias("area"))


@query()
def n06_mask_regions(spark, sf_dir):
    return masks.measured(run_lengths(spark, sf_dir), "doc_id", "counts", 8, 16)


@query()
def u11_degraded(spark, sf_dir):
    content = table(spark, sf_dir, "documents").select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("content"))
    out = degrade.degrade(content, "doc_id", "content")
    return out.select("doc_id", "regions", "method", "kind", "pattern", "error", *(r6(c).alias(c) for c in ("coverage", "mean_albedo", "mean_shading", "mean_out")))
