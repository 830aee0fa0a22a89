"""Import of survey database files (SQLite) as a Spark data source.

A table is read in ranges of its rowid, each by a task with a read-only
connection. Binary columns of little-endian doubles become arrays; values that
are too short become NULL. Imported tables should be written to Parquet and
used from there.
"""

from __future__ import annotations

import sqlite3
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RANGE_ROWS = 100_000
BATCH_ROWS = 10_000

# Tables of a survey database, their columns, and how many
# doubles a binary column holds (0: any number).
TABLES = {
    "images": "image_id bigint, name string, camera_id bigint",
    "cameras": "camera_id bigint, model int, width int, height int, params array<double>, prior_focal_length int",
    "keypoints": "image_id bigint, rows bigint",
    "matches": "pair_id bigint, rows bigint",
    "two_view_geometries": "pair_id bigint, rows bigint",
    "pose_priors": (
        "pose_prior_id bigint, corr_data_id bigint, corr_sensor_id bigint, corr_sensor_type int, "
        "position array<double>, position_covariance array<double>, gravity array<double>, coordinate_system int"
    ),
    "rigs": "rig_id bigint, ref_sensor_id bigint, ref_sensor_type int",
    "frames": "frame_id bigint, rig_id bigint",
    "frame_data": "frame_id bigint, data_id bigint, sensor_id bigint, sensor_type int",
}
DOUBLES = {"position": 3, "gravity": 3, "position_covariance": 9, "params": 0}
ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<double>": pa.list_(pa.float64())}


def decode_doubles(blob: bytes | None, n: int) -> list[float] | None:
    """Little-endian doubles; NULL when short or when all are NaN."""
    if blob is None or len(blob) < 8 * max(n, 1):
        return None
    values = np.frombuffer(blob[: 8 * n] if n else blob[: len(blob) // 8 * 8], dtype="<f8")
    return None if np.isnan(values).all() else values.tolist()


def _connect(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True, timeout=30)


@dataclass
class RowRange(InputPartition):
    low: int
    high: int


class SurveyTableReader(DataSourceReader):
    def __init__(self, path: str, table: str, range_rows: int):
        self.path, self.table, self.range_rows = path, table, range_rows
        self.columns = [c.strip().split(" ", 1) for c in TABLES[table].split(", ")]

    def partitions(self):
        with _connect(self.path) as con:
            low, high = con.execute(f"SELECT min(rowid), max(rowid) FROM {self.table}").fetchone()
        if low is None:
            return [RowRange(0, 0)]
        return [RowRange(a, min(a + self.range_rows, high + 1)) for a in range(low, high + 1, self.range_rows)]

    def read(self, part):
        names = [n for n, _ in self.columns]
        with _connect(self.path) as con:
            cursor = con.execute(
                f"SELECT {', '.join(names)} FROM {self.table} WHERE rowid >= ? AND rowid < ? ORDER BY rowid",
                (part.low, part.high),
            )
            while rows := cursor.fetchmany(BATCH_ROWS):
                columns = []
                for (name, kind), values in zip(self.columns, zip(*rows)):
                    if kind == "array<double>":
                        values = [decode_doubles(v, DOUBLES[name]) for v in values]
                    columns.append(pa.array(values, ARROW[kind]))
                yield pa.RecordBatch.from_arrays(columns, names=names)


class SurveyDbSource(DataSource):
    """``spark.read.format("surveydb").option("table", t).load(path)``."""

    @classmethod
    def name(cls):
        return "surveydb"

    def schema(self):
        return TABLES[self.options["table"]]

    def reader(self, schema):
        return SurveyTableReader(
            self.options["path"], self.options["table"], int(self.options.get("rangeRows", RANGE_ROWS))
        )


def import_survey_db(spark: SparkSession, path: str, table: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    if table not in TABLES:
        raise ValueError(f"unknown table {table}")
    spark.dataSource.register(SurveyDbSource)
    return spark.read.format("surveydb").option("table", table).option("rangeRows", str(range_rows)).load(path)


def import_all(spark: SparkSession, path: str, out: str) -> None:
    """Every table to Parquet, one folder each."""
    for table in TABLES:
        import_survey_db(spark, path, table).write.mode("overwrite").parquet(f"{out}/{table}")
