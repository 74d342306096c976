"""The corpus pipeline: toxicity, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last
return the columns of ``docs``, whatever else those hold. Null and empty texts
pass every stage but the last, which packs their end id; an empty table gives
an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, fuzzy_lines, order_minhash, packing, toxicity
from tessera.llm.queries import vocabulary
from tessera.llm.storage import materialize, table
from tessera.llm.workers import texts_in_small_batches

#: Documents of at least this toxicity score are rejected.
TOXIC = 0.3


def _free_name(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows whose own text scores below TOXIC; of rows with one id each is judged by itself."""
    texts_in_small_batches(spark)
    score = _free_name(docs, "score")
    scored = toxicity.score_toxicity(docs, toxicity.trained(docs, table(spark, sf_dir, "labels")), keep=True, score_col=score)
    return scored.where(F.col(score) < TOXIC).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows without the lines that stand before, in them or in others; rows of which only blank lines are left go. ``n_chars``, if there, is counted anew."""
    texts_in_small_batches(spark)
    left = fuzzy_lines.without_repeated_lines(docs)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest key. A document is an id, which may be null, and a text: rows of one id with other texts are other documents, rows that share both are one, of which one row is left."""
    texts_in_small_batches(spark)
    key = _free_name(docs, "key")
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_id").isNull(), _text()))
    found = order_minhash.near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"))
    lost = materialize(found.where(~F.col("keep")).select(F.col("doc_id").alias(key)).distinct(), "lost")
    left = keyed.join(lost, key, "left_anti")
    again = materialize(keyed.groupBy(key).count().where("count > 1").select(key), "again")
    if again.isEmpty():
        return left.select(*docs.columns)
    # Only repeated rows are shuffled: one of each.
    rest = left.join(again, key, "left_anti").select(*docs.columns)
    one = left.join(again, key, "left_semi").groupBy(key).agg(F.any_value(F.struct(*docs.columns)).alias("row"))
    return rest.unionByName(one.select("row.*").select(*docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows whose own text holds no window of a benchmark item; of rows with one id each is judged by itself."""
    texts_in_small_batches(spark)
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    hit = found.select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(hit["hit_id"]) & (F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))) == hit["hit_key"])
    return docs.join(hit, same, "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows' token ids in pieces, with the place of each in a sequence of 2048; repeated rows are packed each."""
    texts_in_small_batches(spark)
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("toxicity", reject_toxic), ("line dedup", dedup_lines), ("near dedup", dedup_documents), ("decontamination", drop_contaminated), ("packing", pack)]

#: SQL has no form for the learned score, the sketches or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents``, each from its predecessor's written rows."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, "stage")
    return docs
