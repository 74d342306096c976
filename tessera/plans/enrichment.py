"""Enrichment, write-back and gates: documents stand for images, labels for results of workers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import sampling
from tessera.operators import enrich as E
from tessera.plans.common import query, r6, table


@query("select d.doc_id, case when l.quality = 1 then 'out/' || d.doc_id || '.png' end as output_path from documents d left join (select doc_id, max(quality) as quality from labels group by 1) l on d.doc_id = l.doc_id")
def j01_writeback(spark, sf_dir):
    results = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality")).withColumn("output_path", F.concat(F.lit("out/"), F.col("doc_id").cast("string"), F.lit(".png")))
    rows = table(spark, sf_dir, "documents").select("doc_id")
    return E.write_back(rows, results, "doc_id", ["output_path"], F.col("quality") == 1).select("doc_id", "output_path")


@query("select doc_id % 8 as worker, count(*) filter (quality = 1) as successful, count(*) filter (quality <> 1) as failed from labels group by 1")
def a06_worker_counts(spark, sf_dir):
    return table(spark, sf_dir, "labels").groupBy((F.col("doc_id") % 8).alias("worker")).agg(F.count_if(F.expr("quality = 1")).alias("successful"), F.count_if(F.expr("quality <> 1")).alias("failed"))


KEYWORDS_SQL = "k as (select d.doc_id, case when l.doc_id is not null then 'img/' || d.doc_id end as path, case when l.toxic = 1 then 'ERROR: rejected' when l.quality = 0 then null when d.doc_id % 5 = 0 then 'error: lower' else 'kw ' || d.lang end as keywords from documents d left join labels l on d.doc_id = l.doc_id)"


def keyworded(spark, sf_dir):
    both = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    words = F.when(F.col("toxic") == 1, "ERROR: rejected").when(F.col("quality") == 0, F.lit(None)).when(F.col("doc_id") % 5 == 0, "error: lower").otherwise(F.concat(F.lit("kw "), F.col("lang")))
    return both.select("doc_id", F.when(F.col("toxic").isNotNull(), F.concat(F.lit("img/"), F.col("doc_id").cast("string"))).alias("path"), words.alias("keywords"))


@query(f"with {KEYWORDS_SQL} select doc_id, keywords from k where path is not null and keywords is not null and not starts_with(keywords, 'ERROR:')")
def p02_gate(spark, sf_dir):
    return E.quality_gate(keyworded(spark, sf_dir), "path", "keywords").select("doc_id", "keywords")


@query(f"with {KEYWORDS_SQL} select count(keywords) as total, count(*) filter (starts_with(keywords, 'ERROR:')) as errors, count(keywords) - count(*) filter (starts_with(keywords, 'ERROR:')) as successful from k")
def a07_summary(spark, sf_dir):
    return E.outcome(keyworded(spark, sf_dir), "keywords")


@query(f"with {KEYWORDS_SQL} select 'low/' || doc_id as input_image, trim(keywords) as instruction, path as output_image from k where path is not null and keywords is not null and not starts_with(keywords, 'ERROR:') and doc_id in (select page_id from pages)")
def p03_existing_triplets(spark, sf_dir):
    """The gate, then a semi-join with what exists, then the triplet columns."""
    kept = E.quality_gate(keyworded(spark, sf_dir), "path", "keywords")
    there = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"))
    rows = kept.join(there, "doc_id", "left_semi").withColumn("low", F.concat(F.lit("low/"), F.col("doc_id").cast("string")))
    return E.triplets(rows, "low", "path", "keywords")


@query("select doc_id from documents where doc_id not in (select doc_id from labels)")
def d04_resume(spark, sf_dir):
    return E.remaining(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@query(f"with {KEYWORDS_SQL} select doc_id from documents where doc_id not in (select doc_id from k where keywords is not null and not starts_with(keywords, 'ERROR:'))")
def n14_resume_errors(spark, sf_dir):
    done = keyworded(spark, sf_dir).where(F.col("keywords").isNotNull())
    return E.remaining(table(spark, sf_dir, "documents").select("doc_id"), done, "doc_id", retry_errors=True, text="keywords")


@query("select lang, count(*) as n, count(*) filter (n_chars >= 500 and length(text) >= 500) as valid from documents group by lang")
def p07_split_valid(spark, sf_dir):
    good, bad = E.split_valid(table(spark, sf_dir, "documents"), (F.col("n_chars") >= 500) & (F.char_length("text") >= 500))
    both = good.select("lang", F.lit(1).alias("ok")).unionAll(bad.select("lang", F.lit(0).alias("ok")))
    return both.groupBy("lang").agg(F.count("*").alias("n"), F.sum("ok").alias("valid"))


@query("with w as (select item_id, list_distinct(list_filter(string_split(regexp_replace(text, '\\s+', ' ', 'g'), ' '), lambda x: x <> '')) as ws from benchmark) select item_id, array_to_string(list_transform(list_sort(list_transform(ws, lambda x: [lpad((100000 - length(x))::varchar, 6, '0'), x]))[:3], lambda p: p[2]), ', ') as keywords from w")
def u03_keywords(spark, sf_dir):
    """The stub provider, loaded once a task, in batches."""
    made = E.enrich(table(spark, sf_dir, "benchmark"), "item_id", "text", "keywords", E.provider("words"))
    return made.select("item_id", "keywords")


@query("select doc_id, case when text like '%idiot%' then 'rejected' end as error from documents where text is not null")
def u04_retries(spark, sf_dir):
    """A provider that rejects some texts: its batches fall back to single items, whose rows carry the error."""
    made = E.enrich(table(spark, sf_dir, "documents"), "doc_id", "text", "keywords", E.provider("words", fail_on="idiot"), retries=2)
    return made.select("doc_id", "error")


@query("select event_type, round(avg(value), 6) as avg_seconds, max(value) as peak, count(*) as n from events group by 1")
def a08_timings(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(r6(F.avg("value")).alias("avg_seconds"), F.max("value").alias("peak"), F.count("*").alias("n"))


@query("select event_id from events where value >= 60")
def p09_at_least(spark, sf_dir):
    return table(spark, sf_dir, "events").where("value >= 60").select("event_id")


@query("select event_id from events where value > 60")
def p10_above(spark, sf_dir):
    return table(spark, sf_dir, "events").where("value > 60").select("event_id")


@query("select doc_id, lang from documents where lang not in ('fr', 'de') or lang is null")
def p12_excluded(spark, sf_dir):
    lang = F.col("lang")
    return table(spark, sf_dir, "documents").where(~F.coalesce(lang.isin("fr", "de"), F.lit(False))).select("doc_id", "lang")


@query("with l as (select doc_id, case when doc_id % 3 = 0 then null else quality = 1 end as exhaustive from labels) select doc_id, coalesce(exhaustive, false) as instance_kept, coalesce(exhaustive, true) as pixel_kept from l")
def p17_exhaustive(spark, sf_dir):
    """Instance queries need an explicit yes, pixel queries only an explicit no drops."""
    flag = F.when(F.col("doc_id") % 3 != 0, F.col("quality") == 1)
    return table(spark, sf_dir, "labels").select("doc_id", F.coalesce(flag, F.lit(False)).alias("instance_kept"), F.coalesce(flag, F.lit(True)).alias("pixel_kept"))


@query("select l_orderkey, count(*) as n from lineitem group by 1 having count(*) <= 5")
def p15_few_outputs(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_linenumber").alias("out"))
    return g.where(F.size("out") <= 5).select("l_orderkey", F.size("out").cast("long").alias("n"))


@query("select l_returnflag, count(*) filter (l_discount >= 0.01) as large, count(*) filter (l_linestatus <> 'F') as not_crowd, count(*) filter (l_discount < 0.01 and l_linestatus <> 'F') as small_single from lineitem group by 1")
def p16_p19_targets(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count_if(F.expr("l_discount >= 0.01")).alias("large"), F.count_if(F.expr("l_linestatus <> 'F'")).alias("not_crowd"), F.count_if(F.expr("l_discount < 0.01 and l_linestatus <> 'F'")).alias("small_single"))


U_SQL = "(('0x' || substr(md5('21|' || conv_id || '|' || turn), 1, 12))::bigint / 281474976710656.0::double)"


@query(f"select conv_id, turn, case when {U_SQL} < 0.3 then 'visual' else role end as query from conversations where role is not null")
def p21_overwrite(spark, sf_dir):
    u = sampling.uniform(21, F.col("conv_id"), F.col("turn"))
    return table(spark, sf_dir, "conversations").where(F.col("role").isNotNull()).select("conv_id", "turn", F.when(u < 0.3, "visual").otherwise(F.col("role")).alias("query"))


@query("with g as (select l_orderkey, list(l_partkey order by l_partkey) as ts, count(*) as n from lineitem group by 1) select l_orderkey, ts[(('0x' || substr(md5('4|' || l_orderkey), 1, 12))::bigint % n)::bigint + 1] as target from g")
def p22_visual_query(spark, sf_dir):
    """A repeatable pick of one target."""
    h = F.conv(F.substring(sampling.digest(4, F.col("l_orderkey")), 1, 12), 16, 10).cast("long")
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list("l_partkey")).alias("ts"))
    return g.select("l_orderkey", F.element_at("ts", (h % F.size("ts") + 1).cast("int")).alias("target"))


@query("select p_partkey, p_size from part where p_size between 5 and 40 and p_retailprice < 1500")
def p23_size_limits(spark, sf_dir):
    return table(spark, sf_dir, "part").where("p_size between 5 and 40 and p_retailprice < 1500").select("p_partkey", "p_size")


@query("with s as (select conv_id, turn, dense_rank() over (partition by conv_id order by turn) - 1 as stage from conversations where turn in (0, 2, 4)) select conv_id, turn, stage from s")
def p25_chosen_stages(spark, sf_dir):
    from tessera.operators.annotations import dense_stage

    chosen = spark.createDataFrame([(0,), (2,), (4,)], "turn long")
    kept = table(spark, sf_dir, "conversations").select("conv_id", "turn").join(F.broadcast(chosen), "turn", "left_semi")
    return dense_stage(kept, ["conv_id"], "turn").select("conv_id", "turn", F.col("stage_rank").cast("long").alias("stage"))


@query("with t as (select l_orderkey, l_linenumber, l_quantity as area, case when l_discount > 0.02 then l_discount end as box from lineitem where l_tax > 0.02) select l_orderkey, count(*) as n, count(*) filter (area > 10 and box is not null and box > 0) as cleaned from t group by 1")
def p27_cleaned(spark, sf_dir):
    """Strictly above the score; a zero area, missing or zero box clears the frame."""
    t = table(spark, sf_dir, "lineitem").where("l_tax > 0.02").select("l_orderkey", F.struct(F.when(F.col("l_quantity") > 10, F.col("l_quantity")).alias("area"), F.when(F.col("l_discount") > 0.02, F.array("l_discount")).alias("box")).alias("f"))
    g = t.groupBy("l_orderkey").agg(F.collect_list("f").alias("fs"))
    clear = F.transform("fs", lambda f: F.when(f["area"].isNotNull() & f["box"].isNotNull() & (f["box"][0] > 0), f))
    return g.select("l_orderkey", F.size("fs").cast("long").alias("n"), F.size(F.filter(clear, lambda f: f.isNotNull())).cast("long").alias("cleaned"))


@query("select doc_id, result from (select doc_id, row_number() over (order by doc_id) as i from documents) left join (select 'out/' || doc_id || '.png' as result, row_number() over (order by doc_id) as i from (select distinct doc_id from labels)) using (i)")
def j02_by_position(spark, sf_dir):
    done = table(spark, sf_dir, "labels").select("doc_id").distinct()
    results = done.withColumn("result", F.concat(F.lit("out/"), F.col("doc_id").cast("string"), F.lit(".png")))
    return E.write_back_by_position(table(spark, sf_dir, "documents").select("doc_id"), results, F.col("doc_id"), F.col("doc_id"), ["result"])
