"""Score, filter, rank, band, sample and split: vectors stand for image features, the first seven for prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import sampling, text, vectors
from tessera.operators import rank, stats
from tessera.plans.common import query, r6, table

PROMPTS = 7
SCORED_SQL = """
scored as (select e.vec_id, round(avg(list_dot_product(e.embedding::double[], p.embedding::double[])), 6) as score
  from embeddings e cross join (select * from embeddings where vec_id < 7) p group by e.vec_id)"""
LONG_SQL = """
long as (select e.vec_id, e.label, p.vec_id as prompt, round(list_dot_product(e.embedding::double[], p.embedding::double[]), 6) as score
  from embeddings e cross join (select * from embeddings where vec_id < 7) p)"""


def prompt_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per vector and prompt (J20, long form)."""
    e = table(spark, sf_dir, "embeddings")
    prompts = F.broadcast(e.where(F.col("vec_id") < PROMPTS).select(F.col("vec_id").alias("prompt"), F.col("embedding").alias("p")))
    return e.crossJoin(prompts).select("vec_id", "label", "prompt", r6(vectors.dot("embedding", "p")).alias("score"), vectors.dot("embedding", "p").alias("raw"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompt_scores(spark, sf_dir).groupBy("vec_id").agg(r6(F.avg("raw")).alias("score"))


@query(f"with {SCORED_SQL} select vec_id, score from scored where score >= 0 order by score desc, vec_id limit 100")
def t01_topk_score(spark, sf_dir):
    return rank.top_n(stats.valid_scores(scored(spark, sf_dir), "score"), 100, F.desc("score"), F.asc("vec_id"))


@query(f"with {SCORED_SQL} select vec_id, score from scored")
def j20_prompt_average(spark, sf_dir):
    return scored(spark, sf_dir)


@query(f"with {SCORED_SQL} select count(*) as n_valid, round(sum(score), 4) as total from scored where score >= 0 and not isnan(score)")
def p01_valid_scores(spark, sf_dir):
    return stats.valid_scores(scored(spark, sf_dir), "score").agg(F.count("*").alias("n_valid"), F.round(F.sum("score"), 4).alias("total"))


@query("select vec_id, round(sqrt(list_dot_product(embedding::double[], embedding::double[])), 6) as norm, round(list_dot_product(embedding::double[], (select embedding::double[] from embeddings where vec_id = 0)) / sqrt(list_dot_product(embedding::double[], embedding::double[])) / (select sqrt(list_dot_product(embedding::double[], embedding::double[])) from embeddings where vec_id = 0), 5) as cosine from embeddings")
def f07_vectors(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    first = F.broadcast(e.where("vec_id = 0").select(F.col("embedding").alias("q")))
    return e.crossJoin(first).select("vec_id", r6(vectors.norm("embedding")).alias("norm"), F.round(vectors.cosine("embedding", "q"), 5).alias("cosine"))


STATS_SQL = "count({0}) as count, round(avg({0}), 6) as mean, round(stddev_pop({0}), 6) as std, min({0}) as min, max({0}) as max, round(median({0}), 6) as median, round(quantile_cont({0}, 0.25), 6) as q25, round(quantile_cont({0}, 0.75), 6) as q75"


@query(f"select {STATS_SQL.format('value')} from events where value >= 0 and not isnan(value)")
def a01_stats(spark, sf_dir):
    out = stats.describe(stats.valid_scores(table(spark, sf_dir, "events"), "value"), "value")
    return out.select("count", r6("mean").alias("mean"), r6("std").alias("std"), "min", "max", *(r6(c).alias(c) for c in ("median", "q25", "q75")))


@query(f"with {LONG_SQL} select prompt, round(avg(score), 5) as mean, round(stddev_samp(score), 5) as std, min(score) as min, max(score) as max from long group by prompt")
def a02_prompt_stats(spark, sf_dir):
    out = stats.describe_by(prompt_scores(spark, sf_dir), "prompt", "score")
    return out.select("prompt", F.round("mean", 5).alias("mean"), F.round("std", 5).alias("std"), "min", "max")


RANKED_SQL = "ranked as (select event_id, user_id, event_type, value, row_number() over (order by value desc, event_id) as rn from events)"
BANDS = [("b1", 0, 100), ("b2", 100, 500), ("b3", 500, 1000), ("b4", 1000, 5000), ("b5", 5000, 10000), ("b6", 10000, 1000000000)]


def ranked_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank.global_rank(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value"), F.desc("value"), F.asc("event_id"))


@query(f"""with {RANKED_SQL}, bands(band, lo, hi) as (values {', '.join(str(b) for b in BANDS)})
select band, count(*) as count, min(value) as min_score, max(value) as max_score, round(avg(value), 6) as mean_score, round(median(value), 6) as median_score
from ranked join bands on rn > lo and rn <= hi where hi <= (select count(*) from ranked) group by band""")
def a03_rank_bands(spark, sf_dir):
    out = rank.band_stats(ranked_events(spark, sf_dir), "value", BANDS)
    return out.withColumn("mean_score", r6("mean_score")).withColumn("median_score", r6("median_score"))


@query(f"""with {RANKED_SQL}, s as (select count(*) filter (rn <= 700) as n_selected, count(*) filter (rn > 700) as n_rejected, min(value) filter (rn <= 700) as selected_min,
 round(avg(value) filter (rn <= 700), 6) as selected_mean, max(value) filter (rn > 700) as rejected_max, round(avg(value) filter (rn > 700), 6) as rejected_mean from ranked)
select *, round(selected_min - rejected_max, 6) as gap, case when round(selected_min - rejected_max, 6) > 0.001 then 'clear' when round(selected_min - rejected_max, 6) > 0 then 'small' else 'none' end as separation from s""")
def a04_cutoff_gap(spark, sf_dir):
    out = rank.cutoff_gap(ranked_events(spark, sf_dir), "value", 700)
    return out.withColumn("gap", r6("gap")).withColumn("selected_mean", r6("selected_mean")).withColumn("rejected_mean", r6("rejected_mean"))


@query(f"with {RANKED_SQL}, k as (select value from ranked where rn = 500) select (select value from k) as score_at, count(*) filter (value >= (select value from k)) as n_at_least, count(*) filter (value < (select value from k)) as n_below from ranked")
def a05_score_at_rank(spark, sf_dir):
    ranked = ranked_events(spark, sf_dir)
    at = F.broadcast(ranked.where("rn = 500").select(F.col("value").alias("score_at")))
    return ranked.crossJoin(at).groupBy("score_at").agg(F.count_if(F.col("value") >= F.col("score_at")).alias("n_at_least"), F.count_if(F.col("value") < F.col("score_at")).alias("n_below"))


@query(f"with {RANKED_SQL} select event_id, rn from ranked")
def w01_position(spark, sf_dir):
    return ranked_events(spark, sf_dir).select("event_id", "rn")


@query("select *, row_number() over (order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_shipdate) as rn from lineitem")
def w01_wide_position(spark, sf_dir):
    """The position beside all columns of a table, not only those of the order."""
    li = table(spark, sf_dir, "lineitem")
    first = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_shipdate"]
    return rank.global_rank(li, F.desc("l_extendedprice"), *(F.asc(c) for c in first))


def _case_sql(bands, last, rn="rn"):
    return "case " + " ".join(f"when {rn} <= {top} then '{label}'" for top, label in bands) + f" else '{last}' end"


@query(f"with {RANKED_SQL} select {_case_sql(text.RANK_BANDS, text.LAST_BAND)} as band, count(*) as count from ranked group by 1")
def w02_band_labels(spark, sf_dir):
    return ranked_events(spark, sf_dir).groupBy(text.band_label(F.col("rn")).alias("band")).agg(F.count("*").alias("count"))


@query(f"with {RANKED_SQL} select event_id, rn, case when rn - (rn - 1) % 250 = 1 then 'Top 1-5' else 'Rank ' || (rn - (rn - 1) % 250) end as label from ranked where (rn - 1) % 250 < 5")
def w07_stride(spark, sf_dir):
    return rank.stride_sample(ranked_events(spark, sf_dir), 250, 5).select("event_id", "rn", "label")


@query(f"with {RANKED_SQL} select event_id, rn, value, case when rn <= 700 then 'SELECTED' else 'REJECTED' end as status from ranked where rn between 695 and 705")
def w08_cutoff(spark, sf_dir):
    return rank.neighbourhood(ranked_events(spark, sf_dir), 700).select("event_id", "rn", "value", "status")


@query(f"with {LONG_SQL} select vec_id, prompt, score, row_number() over (partition by prompt order by score desc, vec_id) as rn from long")
def w09_prompt_rank(spark, sf_dir):
    long = prompt_scores(spark, sf_dir)
    return rank.global_rank(long.select("vec_id", "prompt", "score"), F.desc("score"), F.asc("vec_id"), keys=["prompt"])


@query("""with e as (select min(value) lo, max(value) hi from events), b as (select case when hi = lo then 0 else least(floor((value - lo) * 50 / (hi - lo)), 49) end::bigint as bin from events, e)
select bin, count(*) as count from b group by bin""")
def a29_histogram(spark, sf_dir):
    return stats.histogram(table(spark, sf_dir, "events"), "value", 50)


@query(f"""with {SCORED_SQL}, m as (select score, case when vec_id % 10 < 8 then 'train' when vec_id % 10 = 8 then 'val' else 'test' end as split, t.threshold
 from scored, (values (0.0::double), (0.05::double), (0.1::double), (0.15::double)) t(threshold))
select threshold, coalesce(split, 'Total') as split, count(*) filter (score >= threshold) as count from m group by grouping sets ((threshold, split), (threshold))""")
def a28_thresholds(spark, sf_dir):
    of = F.when(F.col("vec_id") % 10 < 8, "train").when(F.col("vec_id") % 10 == 8, "val").otherwise("test")
    return stats.counts_above(scored(spark, sf_dir), "score", [0.0, 0.05, 0.1, 0.15], of)


@query(f"with {SCORED_SQL} (select 'top' as side, vec_id, score from scored order by score desc, vec_id limit 20) union all (select 'bottom', vec_id, score from scored order by score, vec_id limit 20)")
def t07_both_ends(spark, sf_dir):
    s = scored(spark, sf_dir)
    top = rank.top_n(s, 20, F.desc("score"), F.asc("vec_id")).select(F.lit("top").alias("side"), "vec_id", "score")
    return top.unionAll(rank.top_n(s, 20, F.asc("score"), F.asc("vec_id")).select(F.lit("bottom").alias("side"), "vec_id", "score"))


@query("select doc_id, lang from documents order by doc_id limit 50")
def t02_head(spark, sf_dir):
    return rank.top_n(table(spark, sf_dir, "documents").select("doc_id", "lang"), 50, F.asc("doc_id"))


HASH_SQL = "hashed as (select doc_id, lang, row_number() over (order by md5('42|' || doc_id), doc_id) as rn, count(*) over () as n from documents)"


@query(f"with {HASH_SQL} select doc_id, case when rn <= floor(n * 0.8) then 'train' when rn <= floor(n * 0.8) + floor(n * 0.1) then 'val' else 'test' end as split from hashed")
def r01_split(spark, sf_dir):
    """Exact floor sizes, the rest to test; the order is a seeded hash, numbered without one task for all rows."""
    d = table(spark, sf_dir, "documents").select("doc_id").withColumn("h", sampling.digest(42, F.col("doc_id")))
    n = F.broadcast(d.agg(F.count("*").alias("n")))
    ranked = rank.global_rank(d, F.asc("h"), F.asc("doc_id")).crossJoin(n)
    train, val = F.floor(F.col("n") * 0.8), F.floor(F.col("n") * 0.1)
    return ranked.select("doc_id", F.when(F.col("rn") <= train, "train").when(F.col("rn") <= train + val, "val").otherwise("test").alias("split"))


@query("select doc_id from documents order by md5('7|' || doc_id), doc_id limit 20")
def r02_seeded_sample(spark, sf_dir):
    return rank.top_n(table(spark, sf_dir, "documents").select("doc_id"), 20, sampling.digest(7, F.col("doc_id")), F.asc("doc_id"))


@query("select event_id from events where event_type = 'click' order by md5('3|' || event_id), event_id limit 100")
def r03_shuffle_select(spark, sf_dir):
    return rank.top_n(table(spark, sf_dir, "events").where("event_type = 'click'").select("event_id"), 100, sampling.digest(3, F.col("event_id")), F.asc("event_id"))


KINDS = [("soft_shading", 0.5), ("hard_shadow", 0.3), ("ambient", 0.2)]
U_SQL = "(('0x' || substr(md5('{0}|' || doc_id), 1, 12))::bigint / 281474976710656.0::double)"


@query(f"with u as (select doc_id, {U_SQL.format(5)} as u from documents) select doc_id, case when u < 0.5 then 'soft_shading' when u < 0.8 then 'hard_shadow' else 'ambient' end as kind from u")
def r05_weighted(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", sampling.weighted_choice(KINDS, sampling.uniform(5, F.col("doc_id"))).alias("kind"))


@query(f"select doc_id, round(0.15 + 0.1 * {U_SQL.format(6)}, 6) as ratio from documents")
def r06_uniform(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", r6(sampling.uniform_in(0.15, 0.25, 6, F.col("doc_id"))).alias("ratio"))


@query(f"""with a as (select doc_id, radians(30 + 60 * {U_SQL.format(8)}) e, radians(360 * {U_SQL.format(9)}) z from documents)
select doc_id, round(cos(e) * cos(z), 6) + 0.0 as x, round(cos(e) * sin(z), 6) + 0.0 as y, round(sin(e), 6) as z from a""")
def r07_hemisphere(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", sampling.hemisphere(sampling.uniform(8, F.col("doc_id")), sampling.uniform(9, F.col("doc_id")), 30.0, 90.0).alias("v"))
    return d.select("doc_id", (r6(F.col("v")[0]) + 0.0).alias("x"), (r6(F.col("v")[1]) + 0.0).alias("y"), r6(F.col("v")[2]).alias("z"))


@query("select doc_id, ntile(3) over (order by doc_id) as worker from documents")
def r08_ntile(spark, sf_dir):
    """Even contiguous parts, the first ones a row longer: from the global rank and the count, as ntile would."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    n = F.broadcast(d.agg(F.count("*").alias("n")))
    r = rank.global_rank(d, F.asc("doc_id")).crossJoin(n)
    size, rest, at = F.floor(F.col("n") / 3), F.col("n") % 3, F.col("rn") - 1
    worker = F.when(at < rest * (size + 1), F.floor(at / (size + 1))).otherwise(rest + F.floor((at - rest * (size + 1)) / F.greatest(size, F.lit(1))))
    return r.select("doc_id", (worker + 1).alias("worker"))


@query("with p as (select page_id, url, lower(regexp_replace(regexp_extract(url, '([^/]*)$', 1), '(.)\\.[^.]*$', '\\1')) as stem from pages) select page_id, case when stem like '%train%' then 'train' when stem like '%val%' then 'val' when stem like '%test%' then 'test' else 'data' end as split from p")
def r09_split_name(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.split_name(F.col("url")).alias("split"))


@query("select conv_id, list(turn order by turn desc) as turns from conversations where conv_id % 2 = 0 group by conv_id union all select conv_id, list(turn order by turn) from conversations where conv_id % 2 = 1 group by conv_id")
def r12_reversed(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return c.select("conv_id", F.when(F.col("conv_id") % 2 == 0, F.reverse("turns")).otherwise(F.col("turns")).alias("turns"))


@query("select page_id, regexp_extract(url, '([^/]*)$', 1) as name, format('{:06d}_{}', page_id, regexp_extract(url, '([^/]*)$', 1)) as numbered, 'data:image/jpeg;base64,' || base64(encode(html)) as data_url, case when length(html) > 80 then left(html, 80) || '...' else html end as preview from pages where not regexp_matches(url, '\\.(png|gif|webp|bmp)$')")
def f02_paths(spark, sf_dir):
    p, url = table(spark, sf_dir, "pages"), F.col("url")
    p = p.where(~url.rlike(r"\.(png|gif|webp|bmp)$"))
    return p.select("page_id", text.file_name(url).alias("name"), text.numbered_name(F.col("page_id"), text.file_name(url)).alias("numbered"), text.data_url(url, F.col("html").cast("binary")).alias("data_url"), text.preview(F.col("html")).alias("preview"))


@query("select vec_id, label, replace('good lighting ' || label, ' ', '_') as column_name, case when lower(trim(' Class ' || label)) = 'class 3' then 'a photo of ' || ' Class ' || label || '!' else ' Class ' || label end as affixed from embeddings")
def f01_strings(spark, sf_dir):
    label = F.concat(F.lit(" Class "), F.col("label").cast("string"))
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", text.column_name(F.concat(F.lit("good lighting "), F.col("label").cast("string"))).alias("column_name"), text.affixed(label, "a photo of ", "!", "class 3").alias("affixed"))


@query("select p_partkey, case when p_size > 40 or p_size % 7 = 0 then p_name || '/full/full/0/default.jpg' else p_name || '/full/20,/0/default.jpg' end as url from part where p_size > 40 or p_size % 7 = 0 or p_size > 20 union all select p_partkey, p_name || '/full/full/0/default.jpg' from part where not (p_size > 40 or p_size % 7 = 0 or p_size > 20)")
def f04_urls(spark, sf_dir):
    width = F.when(F.col("p_size") > 40, F.lit(float("nan"))).when(F.col("p_size") % 7 == 0, F.lit(None)).otherwise(F.col("p_size").cast("double"))
    return table(spark, sf_dir, "part").select("p_partkey", text.sized_url(F.col("p_name"), width, 20).alias("url"))


@query("select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k, round(log10(value + 1), 5) as log_value from events where json_extract_string(props, '$.k') is not null")
def s08_json_field(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "value", F.get_json_object("props", "$.k").cast("long").alias("k"))
    return e.where(F.col("k").isNotNull()).select("event_id", "k", F.round(F.log10(F.col("value") + 1), 5).alias("log_value"))
