"""Readers and writers with declared schemas and checked columns."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators.rank import global_rank

# Image extensions.
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "bmp", "webp")
# Names under which a triplet file may lie, in order of preference.
TRIPLET_FILES = ("metadata.jsonl", "metadata.json", "instructions.jsonl", "instructions.json", "data.jsonl", "data.json")
SCORES = "image_path string, lighting_score double"
TRIPLET = "input_image string, instruction string, output_image string"


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def bind_column(df: DataFrame, wanted: str | None, position: int) -> str:
    """A column by name, or by position where no name is given."""
    if wanted is None:
        return df.columns[position]
    require_columns(df, [wanted])
    return wanted


def find_files(spark: SparkSession, folder: str, extensions: Iterable[str] = IMAGE_EXTENSIONS) -> DataFrame:
    """``path, length`` of the files below a folder, either case of each extension, sorted by path."""
    names = ",".join(x for e in extensions for x in (e.lower(), e.upper()))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{{{names}}}").load(folder)
    return files.select("path", "length").orderBy("path")


def find_configs(spark: SparkSession, folder: str, name: str, skip: str = "/code/") -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name).load(folder)
    return files.select("path").where(~F.col("path").contains(skip))


def find_frames(spark: SparkSession, folder: str, extensions: Iterable[str] = IMAGE_EXTENSIONS) -> DataFrame:
    """Frames of a video folder by the number in their name, or by name where it is none."""
    stem = F.regexp_extract("path", r"([^/]*)\.[^.]*$", 1)
    files = find_files(spark, folder, extensions).select("path", stem.alias("stem"))
    if files.isEmpty():
        raise ValueError(f"no frames in {folder}")
    return files.orderBy(F.expr("try_cast(stem as bigint)"), "stem")


def read_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header, JSON lines or an array of records, by suffix."""
    if path.endswith(".csv"):
        return spark.read.csv(path, header=True, schema=schema, mode="FAILFAST")
    if path.endswith(".jsonl"):
        return spark.read.schema(schema).json(path)
    if path.endswith(".json"):
        return spark.read.schema(schema).json(path, multiLine=True)
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    raise ValueError(f"unknown table format: {path}")


def read_records(spark: SparkSession, path: str, schema: str = TRIPLET) -> DataFrame:
    """JSON lines (blank lines skipped), a list of records, or ``{"data": [...]}``."""
    if path.endswith(".jsonl"):
        return spark.read.schema(schema).json(path)
    raw = spark.read.text(path, wholetext=True)
    whole = F.trim(F.col("value"))
    records = F.when(whole.startswith("["), F.from_json(whole, f"array<struct<{_ddl(schema)}>>")).otherwise(F.from_json(whole, f"struct<data: array<struct<{_ddl(schema)}>>>")["data"])
    return raw.select(F.explode(records).alias("r")).select("r.*")


def _ddl(schema: str) -> str:
    return ", ".join(": ".join(part.split()) for part in schema.split(","))


def first_existing(spark: SparkSession, folder: str, names: Iterable[str] = TRIPLET_FILES) -> str:
    jvm = spark._jvm
    for name in names:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return f"{folder}/{name}"
    raise FileNotFoundError(f"none of {', '.join(names)} in {folder}")


def read_field(spark: SparkSession, glob: str, field: str, kind: str = "double") -> DataFrame:
    """One field of many small JSON files; files without it are skipped."""
    raw = spark.read.text(glob, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.get_json_object("value", f"$.{field}").cast(kind).alias(field))
    return raw.where(F.col(field).isNotNull())


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("path")).where("path <> ''")


def last_record(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Chosen keys of the last valid JSON line of each file; files without one give no row."""
    lines = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.posexplode(F.split("value", "\n")).alias("no", "line"))
    good = lines.where(F.get_json_object("line", "$").isNotNull() & F.trim("line").startswith("{"))
    last = good.groupBy("file").agg(F.max_by("line", "no").alias("line"))
    return last.select("file", *(F.get_json_object("line", f"$.{k}").alias(k) for k in keys))


COCO = "images array<struct<id: bigint, width: int, height: int, file_name: string>>, annotations array<struct<id: bigint, image_id: bigint, category_id: bigint, bbox: array<double>, area: double, iscrowd: int, segmentation: string>>, categories array<struct<id: bigint, name: string>>, info string, licenses string"
VIDEO = "videos array<struct<id: bigint, width: int, height: int, length: int, file_names: array<string>>>, annotations array<struct<id: bigint, video_id: bigint, category_id: bigint, bboxes: array<array<double>>, areas: array<double>>>, categories array<struct<id: bigint, name: string>>, video_np_pairs array<struct<video_id: bigint, category_id: bigint, noun_phrase: string>>, info string, licenses string"


def read_annotation_tables(spark: SparkSession, path: str, schema: str = COCO) -> dict[str, DataFrame]:
    """One table for each top-level key of annotation documents, with the file's stem.

    A segmentation stays the JSON text it is, polygons or run lengths (``operators.masks.segmentation_runs`` reads either); so do
    ``info`` and ``licenses``, a row a document.
    """
    raw = spark.read.schema(schema).json(path, multiLine=True).withColumn("stem", F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", ""))
    texts = {f.name for f in raw.schema if f.dataType.simpleString() == "string"} - {"stem"}
    tables = {key: raw.select("stem", F.explode(key).alias("r")).select("stem", "r.*") for key in raw.columns if key not in texts and key != "stem"}
    return tables | {key: raw.select("stem", key).where(F.col(key).isNotNull()) for key in texts}


def checked_video_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Video tables; fails if a phrase pair names an unknown category or disagrees with its name."""
    tables = read_annotation_tables(spark, path, VIDEO)
    names = tables["categories"].select("stem", F.col("id").alias("category_id"), "name")
    wrong = tables["video_np_pairs"].join(names, ["stem", "category_id"], "left").where(F.col("name").isNull() | (F.col("name") != F.col("noun_phrase")))
    if not wrong.isEmpty():
        raise ValueError("video_np_pairs do not agree with categories")
    return tables


def write_paths(df: DataFrame, path: str, column: str = "path") -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def write_records(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_triplets(df: DataFrame, folder: str) -> DataFrame:
    """JSON lines, parquet and a one-row count beside them."""
    write_records(df, f"{folder}/jsonl")
    df.write.mode("overwrite").parquet(f"{folder}/parquet")
    stats = df.agg(F.count("*").alias("num_samples"), F.count_distinct("instruction").alias("num_instructions"))
    write_records(stats, f"{folder}/stats")
    return stats


def write_splits(df: DataFrame, folder: str, split: str = "split") -> None:
    """One folder for each split, with every column."""
    df.write.mode("overwrite").partitionBy(split).csv(folder, header=True)


def manifest(samples: DataFrame, name: str) -> DataFrame:
    """Counts of a run by outcome; the samples stay a table beside it."""
    return samples.agg(F.lit(name).alias("dataset_name"), F.count("*").alias("total_attempted"), F.count_if(F.col("success")).alias("successful"), F.count_if(~F.col("success")).alias("failed"))


def copy_files(files: DataFrame, target: str) -> DataFrame:
    """Stores ``path, content`` under ``{index:06d}_{name}``, numbered by path, as a table of bytes; returns path and name."""
    numbered = global_rank(files.select("path"), F.asc("path"), name="index")
    named = numbered.select("path", F.format_string("%06d_%s", F.col("index") - 1, F.element_at(F.split("path", "/"), -1)).alias("name"))
    named.join(files, "path").select("name", "content").write.mode("overwrite").parquet(target)
    return named


def to_json_text(rows: list[dict]) -> str:
    """The indented array form, for small exports from the driver."""
    return json.dumps(rows, indent=2, ensure_ascii=False)
