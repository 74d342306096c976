"""Files of records: a sink whose tasks' files appear whole or not at all, and a source of frames.

Both are Python data sources. Paths are of any store that ``pyarrow.fs`` opens
by name (a plain path is a local or mounted one), which the driver and all
executors must see.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

from tessera.sources.io import IMAGE_EXTENSIONS

ARTEFACT = "record_id long, kind string, extension string, content binary"
FRAME = "resource string, frame long, path string, length long, content binary"
MANIFEST = "metadata.json"


def opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path if re.match(r"\w+://|/", path) else f"/{path}")


@dataclass
class Part(WriterCommitMessage):
    """What a task has written: its folder in the staging folder, its files and records."""

    folder: str
    files: int
    records: int


class ArtefactWriter(DataSourceWriter):
    """Each task writes into a folder of its own below a staging folder; the commit moves folders, a call each, then writes the manifest.

    A task that fails or runs twice leaves its folder in the staging folder,
    which goes in the end either way. The manifest is the last file: where it
    names a part, that part is whole.
    """

    def __init__(self, path: str, name: str, overwrite: bool):
        self.path, self.name, self.overwrite = path.rstrip("/"), name, overwrite
        self.staging = f"_staging-{uuid.uuid4().hex}"

    def write(self, rows: Iterator) -> Part:
        fs, root = opened(self.path)
        folder = f"part-{uuid.uuid4().hex}"
        here, files, ids = f"{root}/{self.staging}/{folder}", 0, set()
        fs.create_dir(here)
        with fs.open_output_stream(f"{here}/samples.jsonl") as samples:
            for row in rows:
                name = f"{row['record_id']:05d}_{row['kind']}.{row['extension']}"
                with fs.open_output_stream(f"{here}/{name}") as out:
                    out.write(bytes(row["content"] or b""))
                samples.write((json.dumps({"record_id": row["record_id"], "kind": row["kind"], "file": f"{folder}/{name}"}) + "\n").encode())
                files += 1
                ids.add(row["record_id"])
        return Part(folder, files, len(ids))

    def commit(self, messages: list) -> None:
        fs, root = opened(self.path)
        before = manifest(self.path)
        kept = [] if self.overwrite else before["parts"]
        parts = [m for m in messages if m is not None and m.files]
        for m in parts:
            fs.move(f"{root}/{self.staging}/{m.folder}", f"{root}/{m.folder}")
        now = {"dataset_name": self.name, "num_files": sum(m.files for m in parts), "num_samples": sum(m.records for m in parts), "parts": [*kept, *(m.folder for m in parts)]}
        if not self.overwrite:
            now = {**now, "num_files": now["num_files"] + before["num_files"], "num_samples": now["num_samples"] + before["num_samples"]}
        with fs.open_output_stream(f"{root}/{self.staging}/{MANIFEST}") as out:
            out.write(json.dumps(now, indent=2).encode())
        fs.move(f"{root}/{self.staging}/{MANIFEST}", f"{root}/{MANIFEST}")
        fs.delete_dir(f"{root}/{self.staging}")
        for old in before["parts"] if self.overwrite else []:
            fs.delete_dir(f"{root}/{old}")

    def abort(self, messages: list) -> None:
        fs, root = opened(self.path)
        if fs.get_file_info(f"{root}/{self.staging}").type != pyarrow.fs.FileType.NotFound:
            fs.delete_dir(f"{root}/{self.staging}")


def manifest(path: str) -> dict:
    """The counts of a folder of artefacts and its whole parts; none where nothing was committed."""
    fs, root = opened(path)
    if fs.get_file_info(f"{root}/{MANIFEST}").type == pyarrow.fs.FileType.NotFound:
        return {"dataset_name": "", "num_files": 0, "num_samples": 0, "parts": []}
    with fs.open_input_stream(f"{root}/{MANIFEST}") as f:
        return json.loads(f.read())


class Artefacts(DataSource):
    @classmethod
    def name(cls) -> str:
        return "artefacts"

    def schema(self) -> str:
        return ARTEFACT

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return ArtefactWriter(self.options["path"], self.options.get("dataset", ""), overwrite)


def write_artefacts(df: DataFrame, path: str, dataset: str = "", overwrite: bool = False) -> dict:
    """Writes ``record_id, kind, extension, content`` as files ``{record_id:05d}_{kind}.{extension}`` in a folder a task, and returns the manifest.

    A record's rows go to one task, so its files are in one folder, and a record counts once.
    """
    df.sparkSession.dataSource.register(Artefacts)
    rows = df.select("record_id", "kind", "extension", "content").repartition("record_id")
    rows.write.format("artefacts").mode("overwrite" if overwrite else "append").option("dataset", dataset).save(path)
    return manifest(path)


def read_artefacts(spark: SparkSession, path: str) -> DataFrame:
    """``record_id, kind, extension, content`` of the whole parts of a folder; tasks open the files that the parts' lists name, so the driver lists no file but those lists."""
    parts = [f"{path}/{p}" for p in manifest(path)["parts"]]
    if not parts:
        return spark.createDataFrame([], ARTEFACT)
    listed = spark.read.schema("record_id long, kind string, file string").json([f"{p}/samples.jsonl" for p in parts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = opened(path)
        schema = pa.schema([("record_id", pa.int64()), ("kind", pa.string()), ("extension", pa.string()), ("content", pa.binary())])
        for b in batches:
            # A few files at a time: contents may be of any size.
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64).to_pydict()
                contents = []
                for file in part["file"]:
                    with fs.open_input_stream(f"{root.rstrip('/')}/{file}") as f:
                        contents.append(f.read())
                yield pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip((part["record_id"], part["kind"], [f.rsplit(".", 1)[-1] for f in part["file"]], contents), schema, strict=True)], schema=schema)

    return listed.mapInArrow(run, ARTEFACT)


@dataclass
class Frames(InputPartition):
    """Frames ``first`` to ``last``, the end not included, of a resource, or all frames of several."""

    resources: tuple[str, ...]
    first: int = 0
    last: int | None = None
    names: tuple[str, ...] = ()


class FrameReader(DataSourceReader):
    """One partition for each ``per_task`` frames of a resource, or for each ``per_task`` resources of a list.

    Without ``content`` no file of a folder is opened.
    """

    def __init__(self, options: dict):
        self.path = options["path"]
        self.per_task = int(options.get("per_task", 64))
        self.content = options.get("content", "true") == "true"
        self.low, self.high = 0, None

    def _within(self, n: int) -> tuple[int, int]:
        return min(self.low, n), n if self.high is None else max(min(self.low, n), min(self.high, n))

    def partitions(self) -> Sequence[Frames]:
        if self.path.endswith((".txt", ".list")):
            fs, at = opened(self.path)
            with fs.open_input_stream(at) as f:
                lines = [x for x in (line.strip() for line in f.read().decode().splitlines()) if x]
            return [Frames(tuple(lines[i : i + self.per_task])) for i in range(0, len(lines), self.per_task)] or [Frames(())]
        names = frame_names(self.path)
        first, last = self._within(len(names) if names else n_frames(self.path))
        return [Frames((self.path,), i, min(i + self.per_task, last), tuple(names[i : min(i + self.per_task, last)])) for i in range(first, last, self.per_task)] or [Frames(())]

    def read(self, partition: Frames) -> Iterator[tuple]:
        for resource in partition.resources:
            names = partition.names or tuple(frame_names(resource))
            at = partition.first if partition.names else 0
            if partition.last is None:
                first, last = self._within(len(names) if names else n_frames(resource))
            else:
                first, last = partition.first, partition.last
            for frame in range(first, last):
                yield (resource, frame, *frame_bytes(resource, frame, names[frame - at] if names else None, self.content))


class PrunedFrameReader(FrameReader):
    """Takes over filters on ``frame``: frames that they leave out get no task and are not opened."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if getattr(f, "attribute", None) == ("frame",) and isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual):
                low, high = {EqualTo: (f.value, f.value + 1), GreaterThan: (f.value + 1, None), GreaterThanOrEqual: (f.value, None), LessThan: (0, f.value), LessThanOrEqual: (0, f.value + 1)}[type(f)]
                self.low = max(self.low, low)
                self.high = high if self.high is None else self.high if high is None else min(self.high, high)
            else:
                yield f


class FrameSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "frames"

    def schema(self) -> str:
        return FRAME

    def reader(self, schema: StructType) -> DataSourceReader:
        return (PrunedFrameReader if self.options.get("pruned") == "true" else FrameReader)(self.options)


def frame_names(resource: str) -> list[str]:
    """File names of an image, or of a folder's images by number, or by name where one is no number; none for other resources."""
    if resource.endswith(".npy") or resource.startswith("<"):
        return []
    fs, at = opened(resource)
    info = fs.get_file_info(at)
    if info.type == pyarrow.fs.FileType.File:
        if info.extension.lower() not in IMAGE_EXTENSIONS:
            raise ValueError(f"neither an image, a folder of images, a stack nor a list: {resource}")
        return [info.path]
    found = [f.path for f in fs.get_file_info(pyarrow.fs.FileSelector(at)) if f.is_file and f.extension.lower() in IMAGE_EXTENSIONS]
    if not found:
        raise ValueError(f"no images in {resource}")
    stems = [f.rsplit("/", 1)[-1].rsplit(".", 1)[0] for f in found]
    by_number = all(re.fullmatch(r"\d+", s) for s in stems)
    return [f for _, f in sorted(zip((int(s) if by_number else s for s in stems), found, strict=True))]


def stack(resource: str) -> tuple[pyarrow.NativeFile, tuple[int, ...], np.dtype]:
    """A stack of frames in numpy's format, opened behind its header, and its shape and type."""
    fs, at = opened(resource)
    f = fs.open_input_file(at)
    version = np.lib.format.read_magic(f)
    shape, fortran, kind = np.lib.format.read_array_header_1_0(f) if version == (1, 0) else np.lib.format.read_array_header_2_0(f)
    if fortran or kind.hasobject:
        raise ValueError(f"frames of {resource} do not lie one after another")
    return f, shape, kind


def n_frames(resource: str) -> int:
    if m := re.fullmatch(r"<dummy-video-(\d+)>", resource):
        return int(m[1])
    return stack(resource)[1][0]


def frame_bytes(resource: str, frame: int, name: str | None, content: bool) -> tuple[str, int | None, bytes | None]:
    """Path, length and bytes of a frame. Of a stack only the frame's stretch is read; a dummy video's frame is its number."""
    if name is not None:
        if not content:
            return name, None, None
        with opened(resource)[0].open_input_stream(name) as f:
            data = f.read()
        return name, len(data), data
    if resource.startswith("<"):
        data = frame.to_bytes(8, "little")
        return resource, len(data), data if content else None
    f, shape, kind = stack(resource)
    with f:
        size = int(np.prod(shape[1:])) * kind.itemsize
        if not content:
            return resource, size, None
        return resource, size, f.read_at(size, f.tell() + frame * size)


def read_frames(spark: SparkSession, resource: str, per_task: int = 64, content: bool = True) -> DataFrame:
    """``resource, frame, path, length, content`` of an image, a folder of images, a stack of frames (.npy) or a list of such (.txt, .list, one a line).

    Where ``spark.sql.python.filterPushdown.enabled`` is set, a filter on ``frame`` decides which frames are opened.
    """
    spark.dataSource.register(FrameSource)
    pruned = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format("frames").option("pruned", pruned).option("per_task", per_task).option("content", str(content).lower()).load(resource)
