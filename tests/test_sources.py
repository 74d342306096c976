import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.operators import enrich, rank
from tessera.sources import io


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def test_tables_and_columns(spark, folder):
    df = spark.createDataFrame([("a.jpg", 0.5), ("b.jpg", -1.0)], io.SCORES)
    io.write_csv(df, f"{folder}/t.csv")
    io.write_records(df, f"{folder}/t.jsonl")
    for name in ("t.csv", "t.jsonl"):
        assert sorted(map(tuple, io.read_table(spark, f"{folder}/{name}", io.SCORES).collect())) == [("a.jpg", 0.5), ("b.jpg", -1.0)]
    with pytest.raises(ValueError):
        io.require_columns(df, ["missing"])
    with pytest.raises(ValueError):
        io.read_table(spark, "x.txt", io.SCORES)


def test_records_in_three_forms(spark, folder):
    rows = [{"input_image": "a", "instruction": "b", "output_image": "c"}]
    open(f"{folder}/a.json", "w").write(json.dumps(rows))
    open(f"{folder}/b.json", "w").write(json.dumps({"data": rows}))
    open(f"{folder}/c.jsonl", "w").write("\n" + json.dumps(rows[0]) + "\n\n")
    for n in ("a.json", "b.json", "c.jsonl"):
        assert [tuple(r) for r in io.read_records(spark, f"{folder}/{n}").where("input_image is not null").collect()] == [("a", "b", "c")]


def test_file_scans(spark, folder):
    os.makedirs(f"{folder}/in/deep")
    for n in ("10.JPG", "9.jpg", "deep/2.png", "note.txt"):
        open(f"{folder}/in/{n}", "w").write("x")
    assert [r["stem"] for r in io.find_frames(spark, f"{folder}/in").collect()] == ["2", "9", "10"]
    named = io.copy_files(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{folder}/in").select("path", "content"), f"{folder}/out")
    assert sorted(r["name"] for r in named.collect())[0].startswith("000000_")
    assert spark.read.parquet(f"{folder}/out").count() == 4


def test_annotation_documents(spark, folder):
    doc = {"images": [{"id": 1, "width": 2, "height": 3, "file_name": "a"}], "annotations": [{"id": 7, "image_id": 1, "category_id": 2, "bbox": [0, 0, 1, 1], "area": 1.0, "iscrowd": 0}], "categories": [{"id": 2, "name": "cat"}]}
    open(f"{folder}/x.json", "w").write(json.dumps(doc))
    t = io.read_annotation_tables(spark, f"{folder}/x.json")
    assert t["annotations"].first()["image_id"] == 1 and t["images"].first()["stem"] == "x"


def test_segmentations_of_three_forms(spark, folder):
    """A square of 2 by 2 in an image of 3 rows and 4 columns, as polygon, run lengths and text; info and licenses stay as they are."""
    from tessera.operators import masks

    square = [4, 2, 1, 2, 3]
    forms = {1: [[1, 1, 3, 1, 3, 3, 1, 3]], 2: {"size": [3, 4], "counts": square}, 3: {"size": [3, 4], "counts": "42107"}, 4: None, 5: [], 6: [[0, 0, 1, 0, 1, 1, 0, 1], [3, 2, 4, 2, 4, 3, 3, 3]]}
    coded = spark.createDataFrame([(square,)], "c array<bigint>").select(masks.compressed(F.col("c"))).first()[0]
    forms[3]["counts"] = coded
    doc = {"info": {"year": 2024}, "licenses": [{"id": 1}], "images": [{"id": 1, "width": 4, "height": 3, "file_name": "a"}], "annotations": [{"id": k, "image_id": 1, "category_id": 2, "bbox": [1, 1, 2, 2], "area": 4.0, "iscrowd": 0, "segmentation": s} for k, s in forms.items()], "categories": []}
    open(f"{folder}/x.json", "w").write(json.dumps(doc))
    t = io.read_annotation_tables(spark, f"{folder}/x.json")
    assert json.loads(t["info"].first()["info"]) == {"year": 2024} and json.loads(t["licenses"].first()["licenses"]) == [{"id": 1}]
    sizes = t["images"].select(F.col("id").alias("image_id"), "height", "width")
    rows = masks.segmentation_runs(t["annotations"].join(sizes, "image_id"), ["id"]).collect()
    got = {k: sorted((r["start"], r["stop"]) for r in rows if r["id"] == k) for k in forms}
    assert got == {1: [(4, 6), (7, 9)], 2: [(4, 6), (7, 9)], 3: [(4, 6), (7, 9)], 4: [], 5: [], 6: [(0, 1), (11, 12)]}


def test_last_record_skips_broken_lines(spark, folder):
    open(f"{folder}/a.jsonl", "w").write('{"m": 1}\n{"m": 2}\nbroken\n')
    assert [(r["file"], r["m"]) for r in io.last_record(spark, f"{folder}/*.jsonl", ["m"]).collect()] == [("a.jsonl", "2")]


def test_enrich_falls_back_and_reports(spark):
    df = spark.createDataFrame([(1, "aa bbb"), (2, "bad x"), (3, None)], "id long, text string")
    rows = {r["id"]: r for r in enrich.enrich(df, "id", "text", "kw", enrich.provider("words", fail_on="bad"), retries=2).collect()}
    assert rows[1]["kw"] == "bbb, aa" and rows[1]["error"] is None and rows[2]["error"] == "rejected" and 3 not in rows
    with pytest.raises(ValueError):
        enrich.provider("none")


def test_global_rank_equals_window(spark):
    df = spark.range(1000).withColumn("v", F.col("id") * 7 % 13)
    ranked = rank.global_rank(df, F.desc("v"), F.asc("id"))
    expected = sorted(((i * 7 % 13, i) for i in range(1000)), key=lambda x: (-x[0], x[1]))
    assert [(r["v"], r["id"]) for r in ranked.orderBy("rn").collect()] == expected
    assert [r["rn"] for r in ranked.orderBy("rn").select("rn").collect()] == list(range(1, 1001))
