"""Survey tables derived from the driver's tables, for queries and benches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TAGS = ["camlower", "cammid", "camupper", "HERC"]
CAMERA_ROWS = [
    (0, "PINHOLE", 3840, 2160, [2000.0, 2010.0, 1920.0, 1080.0]),
    (1, "SIMPLE_PINHOLE", 3840, 2160, [1800.0, 1920.0, 1080.0]),
    (2, "OPENCV", 3840, 2160, [1700.0, 1700.0, 1920.0, 1080.0, 0.1, 0.0, 0.0, 0.0]),
    (3, "PINHOLE", 1920, 1080, [1500.0, 1500.0, 960.0, 540.0]),
]
RULE_ROWS = [
    (0, "camlower", "OPENCV", 16.0, 36.0),
    (1, "cammid", "OPENCV_FISHEYE", 12.0, 36.0),
    (2, "towfish", "PINHOLE", 20.0, 36.0),
    (3, "HERC", "OPENCV", 24.0, 36.0),
]
STAGES = {
    "signup": "INITIALIZING",
    "view": "FEATURE_EXTRACTION",
    "click": "MATCHING",
    "purchase": "RECONSTRUCTION",
    "error": "COMPLETE",
}


class Survey:
    """Lazily built survey tables over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # model ---------------------------------------------------------------

    def points(self) -> DataFrame:
        """Points without track length."""
        ok, ck = F.col("o_orderkey"), F.col("o_custkey")
        return self.table("orders").select(
            ok.alias("point_id"),
            ((ck % 1000) / 10.0 - 50).alias("x"),
            ((ok % 977) / 10.0 - 48).alias("y"),
            ((ok * 31 % 613) / 10.0 - 5).alias("z"),
            (ok % 256).alias("r"), (ck % 256).alias("g"), ((ok + ck) % 256).alias("b"),
            (F.col("o_totalprice") / 100000 * (F.col("o_totalprice") / 100000)).alias("error"),
        )

    def tracked_points(self) -> DataFrame:
        lengths = self.table("lineitem").groupBy(F.col("l_orderkey").alias("point_id")).agg(
            F.count(F.lit(1)).alias("track_length")
        )
        return self.points().join(lengths, "point_id", "left").withColumn(
            "track_length", F.coalesce("track_length", F.lit(0))
        )

    def observations(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_partkey").alias("image_id"),
            F.when(F.col("l_returnflag") != "R", F.col("l_orderkey")).alias("point_id"),
            (F.col("l_quantity") * 40).alias("px"), (F.col("l_discount") * 10000).alias("py"),
        )

    def tracks(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("point_id"), F.col("l_partkey").alias("image_id")
        )

    @staticmethod
    def _tag(n: Column) -> Column:
        return F.element_at(F.array(*[F.lit(t) for t in TAGS]), (n % 4 + 1).cast("int"))

    def _image_name(self, key: Column, size: Column) -> Column:
        folder = F.when(key % 3 == 0, "dive1/").otherwise("")
        return F.concat(folder, self._tag(size), F.lit("_"), F.lpad(key.cast("string"), 12, "0"), F.lit(".jpg"))

    def images(self) -> DataFrame:
        pk, size = F.col("p_partkey"), F.col("p_size")
        w, x, y, z = 1.0 + size % 7, size % 5 - 2.0, pk % 3 - 1.0, (pk % 11) / 10.0
        norm = F.sqrt(w * w + x * x + y * y + z * z)
        return self.table("part").select(
            pk.alias("image_id"), self._image_name(pk, size).alias("name"),
            (size % 4).cast("bigint").alias("camera_id"),
            F.array(w / norm, x / norm, y / norm, z / norm).alias("qvec"),
            F.array((pk % 17) / 2.0 - 4, (size % 13) / 4.0, 40.0 + size).alias("tvec"),
        )

    def cameras(self) -> DataFrame:
        return self.spark.createDataFrame(
            CAMERA_ROWS, "camera_id BIGINT, model STRING, width INT, height INT, params ARRAY<DOUBLE>"
        )

    def camera_rules(self) -> DataFrame:
        return self.spark.createDataFrame(
            RULE_ROWS, "rule_idx INT, prefix STRING, model STRING, focal_mm DOUBLE, sensor_width_mm DOUBLE"
        )

    # splats --------------------------------------------------------------

    def splats(self) -> DataFrame:
        e = lambda i: F.element_at("embedding", i).cast("double")
        return self.table("embeddings").select(
            F.col("vec_id").alias("splat_id"),
            e(1).alias("x"), e(2).alias("y"), e(3).alias("z"),
            *[(e(4 + i) * 4).alias(f"f_dc_{i}") for i in range(3)],
            (e(7) * 20).alias("opacity"),
            *[(e(8 + i) * 8 - 2).alias(f"scale_{i}") for i in range(3)],
            *[e(11 + i).alias(f"rot_{i}") for i in range(4)],
        )

    # nav and catalog -----------------------------------------------------

    def nav(self) -> DataFrame:
        key = F.col("c_custkey")
        parts = self.table("part").select("p_partkey", "p_size")
        joined = self.table("customer").join(parts, F.col("p_partkey") == key * 2, "left")
        full = self._image_name(key * 2, F.coalesce("p_size", key))
        acc = lambda v: F.when(key % 5 != 0, v)
        return joined.select(
            F.when(key % 2 == 0, full).otherwise(F.substring_index(full, "/", -1)).alias("name"),
            F.col("c_acctbal").alias("x"), (F.col("c_acctbal") * 0.5 + key).alias("y"),
            ((key % 40) / 4.0 - 650).alias("alt"), (key % 360).cast("double").alias("yaw"),
            (80.0 + key % 10).alias("pitch"), (F.col("c_nationkey") - 12.0).alias("roll"),
            acc(2.0 + key % 3).alias("x_acc"), acc(3.0 + key % 4).alias("y_acc"),
            acc(0.5 + key % 2).alias("alt_acc"), key.alias("line_no"),
        )

    def pose_positions(self) -> DataFrame:
        """Image positions, one per customer."""
        return self.table("customer").select(
            F.col("c_custkey").alias("image_id"),
            F.col("c_acctbal").alias("x"), (F.col("c_acctbal") * 0.5 + F.col("c_custkey")).alias("y"),
        )

    def keypoints(self) -> DataFrame:
        seen = self.table("lineitem").groupBy(F.col("l_partkey").alias("image_id")).agg(
            F.count(F.lit(1)).alias("rows")
        )
        ids = self.table("part").select(F.col("p_partkey").alias("image_id"))
        return ids.join(seen, "image_id", "left").select(
            "image_id",
            F.when(F.col("image_id") % 50 == 0, 0).otherwise(F.coalesce("rows", F.lit(0))).alias("rows"),
        )

    def matches(self) -> DataFrame:
        """Candidate image pairs; ``rows`` counts raw matches, ``verified`` those that passed."""
        n = self.table("part").agg(F.count(F.lit(1)).alias("n")).scalar()
        a = F.col("l_partkey")
        b = (a + F.col("l_suppkey") + 1) % n
        pairs = self.table("lineitem").select(
            F.least(a, b).alias("image_id1"), F.greatest(a, b).alias("image_id2"),
            F.col("l_quantity").cast("bigint").alias("q"), "l_returnflag",
        ).filter(F.col("image_id1") < F.col("image_id2"))
        return pairs.groupBy("image_id1", "image_id2").agg(
            F.sum("q").alias("rows"),
            F.sum(F.when(F.col("l_returnflag") != "R", F.col("q")).otherwise(0)).alias("verified"),
        )

    def two_view(self) -> DataFrame:
        return self.matches().select("image_id1", "image_id2", F.col("verified").alias("rows"))

    def sparse_view(self) -> DataFrame:
        """Verified pairs of a survey with few overlaps: images without any, and many sub-models."""
        n = self.table("part").agg(F.count(F.lit(1)).alias("n")).scalar()
        a = F.col("l_partkey")
        b = (a + F.col("l_suppkey") + 1) % n
        pairs = self.table("lineitem").filter("l_linenumber = 7").select(
            F.least(a, b).alias("image_id1"), F.greatest(a, b).alias("image_id2"),
            F.when((F.col("l_returnflag") == "A") & (F.col("l_quantity") <= 12), F.col("l_quantity").cast("bigint")).otherwise(0).alias("q"))
        return pairs.filter(F.col("image_id1") < F.col("image_id2")).groupBy("image_id1", "image_id2").agg(F.sum("q").alias("rows"))

    def quality_reports(self) -> DataFrame:
        """One broken report text per third image."""
        pk = F.col("p_partkey")
        name = self._image_name(pk, F.col("p_size"))
        content = F.concat(
            F.lit('{"component": {"cameraCount": 1,},\n "cameras": [{"image": "'), name,
            F.lit('", "numPoints": '), (pk * 3).cast("string"),
            F.lit('COMMA_PLACEHOLDER "imageCoverage": 0.'), F.lpad((pk % 100).cast("string"), 2, "0"),
            F.lit(', "reprojError": {"median": '), (pk % 7).cast("string"),
            F.lit('.5, "mean": '), (pk % 9).cast("string"),
            F.lit('.25, }}, ]}\n<!-- exported, with, commas ] -->'),
        )
        return self.table("part").filter(F.col("p_size") % 3 == 0).select(
            pk.alias("report_id"), content.alias("content")
        )

    # events --------------------------------------------------------------

    @staticmethod
    def stage_of(event_type: Column) -> Column:
        known = F.when(F.lit(False), F.lit(None).cast("string"))
        for event, stage in STAGES.items():
            known = known.when(event_type == event, stage)
        return known

    def stage_events(self, events: DataFrame | None = None) -> DataFrame:
        events = self.table("events") if events is None else events
        return events.select(
            "event_id", (F.col("user_id") % 10).alias("run_id"), F.col("ts").cast("timestamp").alias("ts"),
            self.stage_of(F.col("event_type")).alias("stage"), "value",
            F.get_json_object("props", "$.k").cast("bigint").alias("counter"),
        )

    def gpu_samples(self, events: DataFrame | None = None) -> DataFrame:
        events = self.table("events") if events is None else events
        return events.select(
            F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("label"),
            F.floor(F.col("value") * 10).cast("bigint").alias("used_mib"),
        )

    def metric_lines(self, events: DataFrame | None = None) -> DataFrame:
        """Training-log lines, one per event."""
        events = self.table("events") if events is None else events
        n = F.col("event_id")
        pad = lambda v: F.lpad(v.cast("string"), 3, "0")
        line = F.concat(
            F.lit("iter "), n.cast("string"), F.lit(" max_iter=99999999999 loss=0."), pad(n * 7 % 1000),
            F.when(n % 4 == 0, F.concat(F.lit(" PSNR: "), (20 + n % 15).cast("string"), F.lit("."), pad(n % 997)))
            .otherwise(""),
            F.when(n % 6 == 0, F.concat(F.lit(" SSIM=0."), pad(n % 991))).otherwise(""),
            F.lit(" gaussians="), (n * 10).cast("string"), F.lit(",000 it/s="), (n % 150 + 1).cast("string"), F.lit(".5"),
        )
        return events.select(
            (F.col("user_id") % 10).alias("run_id"), n.alias("line_no"),
            F.col("ts").cast("timestamp").alias("ts"), line.alias("line"),
        )

    def stage_logs(self) -> DataFrame:
        """One stage log text per event."""
        kind = F.col("event_type")
        marker = (
            F.when(kind == "signup", "=== feature EXTRACTION ===")
            .when(kind == "view", "x\n=== Feature matching (spatial) ===")
            .when(kind == "click", "Running rotation averaging ...")
            .when(kind == "purchase", "Registering image #12\nthen patch_match")
            .otherwise("nothing known")
        )
        n = F.col("event_id")
        tail = F.when(
            n % 11 != 0,
            F.concat(F.lit("\nElapsed time: "), (n % 90).cast("string"), F.lit("."), (n % 10).cast("string"), F.lit(" [minutes]\n")),
        ).otherwise("\naborted\n")
        return self.table("events").select(
            (F.col("user_id") % 10).alias("run_id"), n.alias("mtime"),
            F.concat(F.lit("log start\n"), marker, tail).alias("content"),
        )
