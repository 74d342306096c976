"""Nested records, lookups, masks as bits, and orders of work."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.functions import sampling
from tessera.operators import rank
from tessera.plans.common import query, r6, table


@query("select e.event_id, e.user_id as conv_id, e.event_id % 4 as turn, c.role, length(coalesce(c.text, '')) as n, c.conv_id is null as missing from events e left join conversations c on c.conv_id = e.user_id and c.turn = e.event_id % 4")
def j28_frame_lookup(spark, sf_dir):
    """The frame that each event asks for: its row in the table of frames, a missing text empty, a missing frame marked."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", F.lit(False).alias("missing"))
    asked = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("conv_id"), (F.col("event_id") % 4).alias("turn"))
    n = F.coalesce(F.char_length("text"), F.lit(0)).cast("long")
    return asked.join(c, ["conv_id", "turn"], "left").select("event_id", "conv_id", "turn", "role", n.alias("n"), F.coalesce("missing", F.lit(True)).alias("missing"))


@query("select d.doc_id, p.url as target, p.url is null as missing from documents d left join pages p on d.doc_id = p.page_id")
def j25_copy_map(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), F.col("url").alias("target"))
    return table(spark, sf_dir, "documents").select("doc_id").join(p, "doc_id", "left").withColumn("missing", F.col("target").isNull())


@query("select event_type, round(avg(case when event_id % 3 <> 0 then value end), 5) as mean, count(case when event_id % 3 <> 0 then value end) as datasets from events group by 1")
def a24_skip_missing(spark, sf_dir):
    v = F.when(F.col("event_id") % 3 != 0, F.col("value"))
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.round(F.avg(v), 5).alias("mean"), F.count(v).alias("datasets"))


@query("select l_orderkey, count(*) filter (l_discount > 0.03) as without_box, bool_or(l_tax > 0.07) as has_output from lineitem group by 1")
def p13_p18_query_kinds(spark, sf_dir):
    """Queries without an input box, and whether any output is left."""
    box = F.when(F.col("l_discount") <= 0.03, F.array("l_discount"))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count_if(box.isNull()).alias("without_box"), F.bool_or(F.col("l_tax") > 0.07).alias("has_output"))


@query("select conv_id, turn, null::varchar as box, role from conversations")
def p20_boxes_removed(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.lit(None).cast("string").alias("box"), "role")


@query("select epoch, doc_id, row_number() over (partition by epoch order by md5('1|' || epoch || '|' || doc_id), doc_id) as place from documents, range(3) e(epoch)")
def n15_epoch_order(spark, sf_dir):
    """Each document's place in another order each epoch, the same on every run."""
    epochs = F.broadcast(spark.range(3).withColumnRenamed("id", "epoch"))
    d = table(spark, sf_dir, "documents").select("doc_id").crossJoin(epochs)
    d = d.withColumn("h", sampling.digest(1, F.col("epoch"), F.col("doc_id")))
    return rank.global_rank(d, F.asc("h"), F.asc("doc_id"), name="place", keys=["epoch"]).select("epoch", "doc_id", "place")


@query("select 'documents' as dataset_name, count(*) as total_attempted, count(*) filter (quality = 1) as successful, count(*) filter (quality <> 1) as failed from labels")
def k07_manifest(spark, sf_dir):
    from tessera.sources.io import manifest

    return manifest(table(spark, sf_dir, "labels").withColumn("success", F.col("quality") == 1), "documents")


BITS = "('0x' || md5(coalesce(text, ''))[1:15])::bigint"


@query(f"select lang, bit_count(bit_or({BITS}))::bigint as area, round(avg(n_chars / 1000), 5) as mean_score from documents group by lang")
def d08_mask_union(spark, sf_dir):
    """The union of a key's masks with their mean score; masks of up to 60 pixels are the bits of a number."""
    bits = F.conv(F.substring(F.md5(F.coalesce("text", F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.bit_count(F.bit_or(bits)).cast("long").alias("area"), F.round(F.avg(F.col("n_chars") / 1000), 5).alias("mean_score"))


@query(f"with m as (select doc_id, lang, doc_id // 20 as image, {BITS} as bits from documents) select a.doc_id as a, b.doc_id as b, round(bit_count(a.bits & b.bits) / bit_count(a.bits | b.bits), 6) as iou from m a join m b on a.image = b.image and a.lang = b.lang and a.doc_id < b.doc_id")
def j18_mask_iou(spark, sf_dir):
    bits = F.conv(F.substring(F.md5(F.coalesce("text", F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")
    m = table(spark, sf_dir, "documents").select("lang", F.floor(F.col("doc_id") / 20).alias("image"), "doc_id", bits.alias("bits"))
    pairs = m.alias("x").join(m.alias("y"), ["image", "lang"]).where("x.doc_id < y.doc_id")
    iou = F.bit_count(F.col("x.bits").bitwiseAND(F.col("y.bits"))) / F.bit_count(F.col("x.bits").bitwiseOR(F.col("y.bits")))
    return pairs.select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"), r6(iou).alias("iou"))


@query("select doc_id, (row_number() over (order by doc_id) - 1) // 32 as batch from documents")
def r10_batches(spark, sf_dir):
    d = rank.global_rank(table(spark, sf_dir, "documents").select("doc_id"), F.asc("doc_id"))
    return d.select("doc_id", F.floor((F.col("rn") - 1) / 32).alias("batch"))


@query("select c_custkey from customer order by md5('300|' || c_custkey), c_custkey limit 300")
def r04_limited_ids(spark, sf_dir):
    return rank.top_n(table(spark, sf_dir, "customer").select("c_custkey"), 300, sampling.digest(300, F.col("c_custkey")), F.asc("c_custkey"))


@query("with g as (select l_orderkey, list(l_partkey order by l_partkey) as xs from lineitem group by 1) select l_orderkey, list_resize(xs, (select max(len(xs)) from g), -1) as padded, len(xs) as n from g")
def f14_padded(spark, sf_dir):
    """Lists padded to the longest found, missing places marked."""
    li = table(spark, sf_dir, "lineitem")
    longest = F.broadcast(li.groupBy("l_orderkey").count().agg(F.max("count").cast("int").alias("m")))
    g = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("l_partkey")).alias("xs")).crossJoin(longest)
    return g.select("l_orderkey", F.concat("xs", F.array_repeat(F.lit(-1).cast("long"), F.col("m") - F.size("xs"))).alias("padded"), F.size("xs").cast("long").alias("n"))


@query("select p_partkey, round(log10(p_retailprice), 6) as log_price, round(greatest(0, least(1, p_size / 40)), 6) as clipped, round((p_retailprice - (select min(p_retailprice) from part)) / ((select max(p_retailprice) - min(p_retailprice) from part) + 1e-8), 5) as scaled, round(atan2(p_size, p_retailprice), 6) as angle from part")
def f06_math(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    ends = F.broadcast(p.agg(F.min("p_retailprice").alias("lo"), F.max("p_retailprice").alias("hi")))
    x = F.col("p_retailprice")
    return p.crossJoin(ends).select("p_partkey", r6(F.log10(x)).alias("log_price"), r6(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("p_size") / 40))).alias("clipped"), F.round((x - F.col("lo")) / (F.col("hi") - F.col("lo") + 1e-8), 5).alias("scaled"), r6(F.atan2("p_size", x)).alias("angle"))


@query("select conv_id, unnest(range(0, n)) as frame_index, unnest(names) as file_name from (select conv_id, count(*) as n, list(format('{:05d}_{}', turn, role) order by turn) as names from conversations where role is not null group by 1)")
def u19_video_frames(spark, sf_dir):
    name = F.format_string("%05d_%s", "turn", "role")
    g = table(spark, sf_dir, "conversations").where("role is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", name.alias("name")))).alias("fs"))
    return g.select("conv_id", F.posexplode("fs.name").alias("frame_index", "file_name")).withColumn("frame_index", F.col("frame_index").cast("long"))


@query("with m as (select conv_id, max(turn) as last, max(turn) // 2 as start from conversations group by 1), f as (select conv_id, unnest(range(start, last + 1)) as frame, 'forward' as direction from m union all select conv_id, unnest(range(0, start)) as frame, 'backward' from m) select conv_id, frame, direction, row_number() over (partition by conv_id order by direction desc, case when direction = 'forward' then frame else -frame end) as step from f")
def n13_both_ways(spark, sf_dir):
    """Forward from the prompt, then backward from it."""
    m = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.max("turn").alias("last"), F.floor(F.max("turn") / 2).alias("start"))
    forward = F.transform(F.sequence("start", "last"), lambda f: F.struct(f.alias("frame"), F.lit("forward").alias("direction")))
    back = F.when(F.col("start") > 0, F.reverse(F.sequence(F.lit(0).cast("long"), F.col("start") - 1))).otherwise(F.array().cast("array<bigint>"))
    backward = F.transform(back, lambda f: F.struct(f.alias("frame"), F.lit("backward").alias("direction")))
    return m.select("conv_id", F.posexplode(F.concat(forward, backward)).alias("step", "f")).select("conv_id", "f.frame", "f.direction", (F.col("step") + 1).cast("long").alias("step"))


@query("select doc_id as record_id, 'input' as kind, 'txt' as extension, octet_length(encode(coalesce(text, ''))) as length, sha256(coalesce(text, '')) as sha from documents union all select doc_id, 'metadata', 'json', length('{\"lang\":\"' || lang || '\"}'), sha256('{\"lang\":\"' || lang || '\"}') from documents")
def k06_artefacts(spark, sf_dir):
    """Two files a document, written by the sink and read back."""
    from tessera.sources import artefacts
    from tessera.sources.shared import delete_at_end, shared_dir

    one = lambda kind, extension, content: F.struct(F.lit(kind).alias("kind"), F.lit(extension).alias("extension"), F.encode(content, "UTF-8").alias("content"))
    both = F.array(one("input", "txt", F.coalesce("text", F.lit(""))), one("metadata", "json", F.to_json(F.struct("lang"))))
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"), F.explode(both).alias("a")).select("record_id", "a.*")
    path = f"{shared_dir(spark)}/tessera/artefacts-{uuid.uuid4().hex}"
    delete_at_end(spark, path)
    artefacts.write_artefacts(rows, path, "documents")
    back = artefacts.read_artefacts(spark, path)
    return back.select("record_id", "kind", "extension", F.octet_length("content").cast("long").alias("length"), F.sha2("content", 256).alias("sha"))
