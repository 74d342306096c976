"""The artefact sink with failing tasks, overwriting and appending; the frame source by resource, range and filter."""

import json
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.sources import artefacts as A


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def records(spark, n, text="t"):
    one = lambda kind, extension, content: F.struct(F.lit(kind).alias("kind"), F.lit(extension).alias("extension"), content.cast("binary").alias("content"))
    both = F.array(one("input", "txt", F.concat(F.lit(text), F.col("id").cast("string"))), one("meta_data", "json", F.lit(None)))
    return spark.range(n).select(F.col("id").alias("record_id"), F.explode(both).alias("a")).select("record_id", "a.*")


def read(spark, path):
    return {(r["record_id"], r["kind"], r["extension"]): bytes(r["content"]).decode() for r in A.read_artefacts(spark, path).collect()}


def files(path):
    return sorted(f for _, _, names in os.walk(path) for f in names if not f.endswith(".crc"))


def test_commit_append_overwrite(spark, folder):
    out = A.write_artefacts(records(spark, 7), folder, "faces")
    assert (out["dataset_name"], out["num_files"], out["num_samples"]) == ("faces", 14, 7)
    want = {(i, k, e): t for i in range(7) for k, e, t in (("input", "txt", f"t{i}"), ("meta_data", "json", ""))}
    assert read(spark, folder) == want
    assert "00003_input.txt" in files(folder) and not [d for d in os.listdir(folder) if d.startswith("_staging")]
    listed = [json.loads(line) for p in out["parts"] for line in open(f"{folder}/{p}/samples.jsonl")]
    assert len(listed) == 14 and all(os.path.exists(f"{folder}/{x['file']}") for x in listed)
    again = A.write_artefacts(records(spark, 2, "more").withColumn("record_id", F.col("record_id") + 100), folder, "faces")
    assert (again["num_files"], again["num_samples"]) == (18, 9) and len(read(spark, folder)) == 18
    new = A.write_artefacts(records(spark, 1, "new"), folder, overwrite=True)
    assert new["num_samples"] == 1 and read(spark, folder) == {(0, "input", "txt"): "new0", (0, "meta_data", "json"): ""}
    assert A.write_artefacts(records(spark, 0), f"{folder}/none")["num_files"] == 0 and A.read_artefacts(spark, f"{folder}/none").count() == 0


def test_failing_task_leaves_nothing(spark, folder):
    A.write_artefacts(records(spark, 3), folder)
    before = files(folder)
    bad = records(spark, 40).withColumn("kind", F.when(F.col("record_id") == 33, F.raise_error(F.lit("broken"))).otherwise(F.col("kind")))
    with pytest.raises(Exception, match="broken|[Tt]ask|aborted"):
        A.write_artefacts(bad, folder)
    assert files(folder) == before and not [d for d in os.listdir(folder) if d.startswith("_staging")]


def test_frames(spark, folder):
    for k in (10, 9, 2, 0, 1):
        open(f"{folder}/{k}.JPG", "wb").write(bytes([k]))
    open(f"{folder}/notes.md", "w").write("x")
    rows = A.read_frames(spark, folder, per_task=2)
    assert [(r["frame"], bytes(r["content"])) for r in rows.orderBy("frame").collect()] == [(i, bytes([k])) for i, k in enumerate((0, 1, 2, 9, 10))]
    assert rows.rdd.getNumPartitions() == 3
    assert A.read_frames(spark, f"{folder}/9.JPG").select("frame", "length").collect() == [(0, 1)]
    frames = np.arange(6 * 2 * 3, dtype=np.uint8).reshape(6, 2, 3)
    np.save(f"{folder}/stack.npy", frames)
    got = A.read_frames(spark, f"{folder}/stack.npy", per_task=4).orderBy("frame").collect()
    assert [bytes(r["content"]) for r in got] == [f.tobytes() for f in frames]
    assert {r["content"] for r in A.read_frames(spark, folder, content=False).collect()} == {None}
    with open(f"{folder}/all.txt", "w") as f:
        f.write(f"{folder}/stack.npy\n\n<dummy-video-3>\n{folder}\n")
    assert {r["resource"]: r["count"] for r in A.read_frames(spark, f"{folder}/all.txt", per_task=1).groupBy("resource").count().collect()} == {f"{folder}/stack.npy": 6, "<dummy-video-3>": 3, folder: 5}
    os.makedirs(f"{folder}/names")
    for k in ("b2", "a10"):
        open(f"{folder}/names/{k}.png", "wb").write(b"")
    assert [r["path"].rsplit("/")[-1] for r in A.read_frames(spark, f"{folder}/names").orderBy("frame").collect()] == ["a10.png", "b2.png"]
    os.makedirs(f"{folder}/empty")
    for bad in ("empty", "notes.md"):
        with pytest.raises(Exception, match="no images|neither an image"):
            A.read_frames(spark, f"{folder}/{bad}").count()


def test_frame_ranges_are_pruned(spark):
    """A reader opens only what the filters leave."""
    reader = A.PrunedFrameReader({"path": "<dummy-video-100>", "per_task": "10"})
    left = list(reader.pushFilters([A.GreaterThan(("frame",), 24), A.LessThanOrEqual(("frame",), 41), A.EqualTo(("path",), "x")]))
    assert left == [A.EqualTo(("path",), "x")]
    assert [(p.first, p.last) for p in reader.partitions()] == [(25, 35), (35, 42)]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        rows = A.read_frames(spark, "<dummy-video-100>", per_task=10).where("frame between 25 and 41 and length = 8")
        assert rows.rdd.getNumPartitions() == 2 and sorted(r["frame"] for r in rows.collect()) == list(range(25, 42))
        assert A.read_frames(spark, "<dummy-video-100>").where("frame = 500").count() == 0
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_reading_back_lists_no_artefact_on_the_driver(spark, tmp_path):
    """The files of artefacts are many; the driver knows only the lists of the parts."""
    rows = spark.range(300).selectExpr("id as record_id", "'input' as kind", "'txt' as extension", "cast(repeat('x', cast(id % 3 as int)) as binary) as content")
    A.write_artefacts(rows, str(tmp_path / "out"), "many")
    back = A.read_artefacts(spark, str(tmp_path / "out"))
    assert all(f.endswith("/samples.jsonl") for f in back.inputFiles())
    assert sorted((r["record_id"], r["kind"], r["extension"], bytes(r["content"])) for r in back.collect()) == [(i, "input", "txt", b"x" * (i % 3)) for i in range(300)]
