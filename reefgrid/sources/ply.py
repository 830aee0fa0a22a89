"""Binary little-endian splat (PLY) files as a Spark data source.

The header names the vertex properties and their number; vertices are rows of
fixed size, so a file is read in byte ranges, and written as one valid file per
partition. Files are opened through Arrow's file systems, which cover local and
cluster storage.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

HEADER_BYTES = 65_536
RANGE_ROWS = 1_000_000
BATCH_ROWS = 65_536
#: Vertices of a written file; a task holds no more of them before it writes them.
FILE_ROWS = 1_000_000
_HEADER_END = b"\nend_header"

# Vertex property types of the file format.
NUMPY_TYPES = {
    "char": "i1", "uchar": "u1", "short": "<i2", "ushort": "<u2", "int": "<i4", "uint": "<u4",
    "float": "<f4", "double": "<f8", "int8": "i1", "uint8": "u1", "int16": "<i2", "uint16": "<u2",
    "int32": "<i4", "uint32": "<u4", "float32": "<f4", "float64": "<f8",
}
SPARK_TYPES = {"i1": "smallint", "u1": "smallint", "i2": "smallint", "u2": "int", "i4": "int", "u4": "bigint", "f4": "float", "f8": "double"}
ARROW_TYPES = {"smallint": "int16", "int": "int32", "bigint": "int64", "float": "float32", "double": "float64"}
PLY_TYPES = {"float": "float", "double": "double", "int": "int", "smallint": "short", "bigint": "int"}


@dataclass
class Header:
    path: str
    count: int
    offset: int
    dtype: np.dtype


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return fs.LocalFileSystem(), path


def read_header(path: str) -> Header:
    """Vertex count, record layout and data offset; the body is not touched."""
    system, name = _open(path)
    head, end = b"", -1
    with system.open_input_file(name) as f:
        while end < 0:
            more = f.read(HEADER_BYTES)
            if not more:
                raise ValueError(f"{path}: no end of the header")
            # The last line may lie across two reads.
            since = max(0, len(head) - 2 * len(_HEADER_END))
            head += more
            mark = head.find(_HEADER_END, since)
            end = head.find(b"\n", mark + len(_HEADER_END)) if mark >= 0 else -1
    end += 1
    count, columns, element = 0, [], None
    for line in head[:end].decode("ascii").splitlines():
        words = line.split()
        if words[:1] == ["format"] and words[1] != "binary_little_endian":
            raise ValueError(f"{path}: only binary_little_endian is supported")
        if words[:1] == ["element"]:
            element = words[1]
            if element == "vertex":
                count = int(words[2])
        elif words[:1] == ["property"] and element == "vertex":
            columns.append((words[2], NUMPY_TYPES[words[1]]))
    return Header(path, count, end, np.dtype(columns))


def list_ply(path: str) -> list[str]:
    """One file, or the ply files of a folder in name order."""
    system, name = _open(path)
    info = system.get_file_info(name)
    if info.type == fs.FileType.File:
        return [path]
    found = system.get_file_info(fs.FileSelector(name, recursive=True))
    prefix = path[: len(path) - len(name)] if path.endswith(name) else ""
    return sorted(prefix + f.path for f in found if f.type == fs.FileType.File and f.path.endswith(".ply"))


@dataclass
class VertexRange(InputPartition):
    path: str
    first: int
    rows: int
    offset: int
    base: int


class PlyReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, range_rows: int):
        self.path, self.schema, self.range_rows = path, schema, range_rows

    def partitions(self):
        ranges, base = [], 0
        for path in list_ply(self.path):
            head = read_header(path)
            for first in range(0, head.count, self.range_rows):
                ranges.append(VertexRange(path, first, min(self.range_rows, head.count - first), head.offset, base))
            base += head.count
        return ranges or [VertexRange("", 0, 0, 0, 0)]

    def read(self, part):
        if not part.rows:
            return
        dtype = read_header(part.path).dtype
        system, name = _open(part.path)
        kinds = {f.name: ARROW_TYPES[f.dataType.simpleString()] for f in self.schema.fields}
        with system.open_input_file(name) as f:
            for start in range(part.first, part.first + part.rows, BATCH_ROWS):
                n = min(BATCH_ROWS, part.first + part.rows - start)
                block = np.frombuffer(f.read_at(n * dtype.itemsize, part.offset + start * dtype.itemsize), dtype=dtype)
                columns = []
                for column, kind in kinds.items():
                    if column == "splat_id":
                        columns.append(pa.array(part.base + start + np.arange(n, dtype=np.int64)))
                    elif column in dtype.names:
                        columns.append(pa.array(np.ascontiguousarray(block[column])).cast(kind))
                    else:
                        columns.append(pa.nulls(n, kind))
                yield pa.RecordBatch.from_arrays(columns, names=list(kinds))


@dataclass
class Written(WriterCommitMessage):
    staged: list[str]


class PlyWriter(DataSourceArrowWriter):
    """Tasks write into a staging folder; the commit moves their files to the output, then removes those of earlier writes.

    Until then the output is as it was, so a write that fails leaves the old
    cloud whole, and a cloud may be written over the one it is read from.
    """

    def __init__(self, path: str, columns: list[tuple[str, str]], overwrite: bool):
        self.path, self.columns = path, columns
        self.write_id = uuid.uuid4().hex[:12]
        system, name = _open(path)
        system.create_dir(name, recursive=True)
        self.old = list_ply(path) if overwrite else []

    def _staging(self) -> str:
        return f"{_open(self.path)[1]}/_staging-{self.write_id}"

    def _put(self, name: str, batches: list[np.ndarray]) -> str:
        lines = ["ply", "format binary_little_endian 1.0", f"element vertex {sum(map(len, batches))}"]
        lines += [f"property {kind} {c}" for c, kind in self.columns] + ["end_header", ""]
        system, _ = _open(self.path)
        with system.open_output_stream(name) as out:
            out.write("\n".join(lines).encode("ascii"))
            for rows in batches:
                out.write(rows.tobytes())
        return name

    def write(self, iterator):
        from pyspark import TaskContext

        task = TaskContext.get()
        dtype = np.dtype([(c, NUMPY_TYPES[kind]) for c, kind in self.columns])
        system, _ = _open(self.path)
        system.create_dir(self._staging(), recursive=True)
        staged, batches, count = [], [], 0
        # The attempt is part of the name: a task that runs twice never writes into its other file.
        name = lambda: f"{self._staging()}/{task.partitionId():06d}-{len(staged):06d}.{task.taskAttemptId()}"
        for batch in iterator:
            rows = np.empty(batch.num_rows, dtype=dtype)
            for c, _ in self.columns:
                rows[c] = batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
            batches.append(rows)
            count += batch.num_rows
            if count >= FILE_ROWS:
                staged.append(self._put(name(), batches))
                batches, count = [], 0
        if count or not staged and not task.partitionId():
            staged.append(self._put(name(), batches))
        return Written(staged)

    def commit(self, messages):
        system, folder = _open(self.path)
        for file in (f for m in messages if m is not None for f in m.staged):
            place = file.rsplit("/", 1)[1].split(".")[0]
            system.move(file, f"{folder}/part-{self.write_id}-{place}.ply")
        for old in self.old:
            system.delete_file(_open(old)[1])
        self._clear()

    def abort(self, messages):
        self._clear()

    def _clear(self) -> None:
        system, _ = _open(self.path)
        if system.get_file_info(self._staging()).type == fs.FileType.Directory:
            system.delete_dir(self._staging())


class PlySource(DataSource):
    """``spark.read.format("ply").load(path)``; adds ``splat_id``, the row number over all files."""

    @classmethod
    def name(cls):
        return "ply"

    def schema(self):
        """Properties of all files, in the order they first appear; where files differ in a type, one that holds both."""
        kinds: dict[str, np.dtype] = {}
        for file in list_ply(self.options["path"]):
            dtype = read_header(file).dtype
            for c in dtype.names or ():
                kinds[c] = np.promote_types(kinds[c], dtype[c]) if c in kinds else dtype[c]
        return ", ".join(["splat_id bigint", *[f"`{c}` {SPARK_TYPES.get(k.str[1:], 'double')}" for c, k in kinds.items()]])

    def reader(self, schema):
        return PlyReader(self.options["path"], schema, int(self.options.get("rangeRows", RANGE_ROWS)))

    def writer(self, schema, overwrite):
        columns = [(f.name, PLY_TYPES[f.dataType.simpleString()]) for f in schema.fields if f.name != "splat_id"]
        return PlyWriter(self.options["path"], columns, overwrite)


def read_splats(spark: SparkSession, path: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    spark.dataSource.register(PlySource)
    return spark.read.format("ply").option("rangeRows", str(range_rows)).load(path)


def splat_counts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Vertex count per file from the headers alone, read in parallel."""
    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, min(len(paths), 1000)))

    def counts(batches):
        for batch in batches:
            heads = [read_header(p) for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.array([h.count for h in heads], pa.int64())], names=["path", "n_splats"]
            )

    return files.mapInArrow(counts, "path string, n_splats bigint")


def write_splats(df: DataFrame, path: str, fmt: str = "parquet", dry_run: bool = False) -> None:
    """Surviving splats in their original order; nothing is written on a dry run."""
    if dry_run:
        return
    ordered = df.repartitionByRange("splat_id").sortWithinPartitions("splat_id")
    if fmt == "ply":
        df.sparkSession.dataSource.register(PlySource)
        ordered.write.format("ply").mode("overwrite").save(path)
    else:
        ordered.write.mode("overwrite").parquet(path)


def rounded_to_float(df: DataFrame) -> DataFrame:
    """Splat properties at the file format's single precision."""
    return df.select("splat_id", *[F.col(c).cast("float").alias(c) for c in df.columns if c != "splat_id"])
