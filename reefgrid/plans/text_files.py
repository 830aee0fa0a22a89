"""Survey files written from the driver's tables, for queries that read them back with the library's readers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reefgrid.plans.views import Survey
from reefgrid.session import scratch_path


#: A large table's text goes into more files: one for so many of its rows.
FILE_ROWS = 2_000_000


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _s(c: Column) -> Column:
    return c.cast("bigint").cast("string")


def _put(lines: DataFrame, out: str, order: list[str], files: int | None = None) -> str:
    """Text in the given order, as one part file after the other."""
    # What belongs together stands in one file.
    placed = lines.repartitionByRange(files, order[0]) if files else lines.coalesce(1)
    placed.sortWithinPartitions(*order).select("line").write.mode("append").text(out)
    return out


def _files(rows: DataFrame, least: int = 3) -> int:
    """The number of files for a text that grows with ``rows``."""
    return max(least, math.ceil(rows.count() / FILE_ROWS))


def _several(df: DataFrame, keys: list[str], *lines: tuple[Column | bool, Column]) -> DataFrame:
    """The given lines of every row whose condition holds, numbered by ``part``."""
    each = F.array(*[F.struct(F.lit(i).alias("part"), F.when(F.lit(c) if isinstance(c, bool) else c, line).alias("line")) for i, (c, line) in enumerate(lines)])
    return df.select(*keys, F.inline(F.filter(each, lambda e: e["line"].isNotNull())))


def write_model(s: Survey) -> str:
    """A sparse model's text files: repeated ids, short lines, comments and strays among them."""
    root, n_files = scratch_path(s.spark, "model"), _files(s.table("lineitem"))
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    seen = s.table("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("track"))
    track = F.concat_ws("", F.transform("track", lambda t: _text(" ", _s(t["l_partkey"]), " ", _s(t["l_linenumber"]))))
    point = _text(_s(ok), " ", _s(ck % 1000), ".5 ", _s(ok % 977), ".25 ", _s(ok * 31 % 613 + 5), " ", _s(ok % 256), " ", _s(ck % 256), " ",
                  _s((ok + ck) % 256), " ", _s(ok % 40), ".125", track)
    orders = s.table("orders").join(seen, "o_orderkey", "left").withColumn("at", ok)
    points = _several(orders, ["at"], (ok % 7 == 0, _text(_s(ok), " 0 0 0 0 0 0 9.5")), (True, point), (ok % 11 == 0, _text(_s(ok), " 1 2 3")), (ok % 13 == 0, _text("# note ", _s(ok))))
    head = s.spark.createDataFrame([(-2, 0, "# 3D point list"), (-1, 0, "#   one line each")], "at bigint, part int, line string")
    _put(points.unionByName(head), f"{root}/points3D.txt", ["at", "part"], n_files)

    pk, size = F.col("p_partkey"), F.col("p_size")
    pose = _text(_s(pk), " 1 0 0 0 ", _s(pk % 17), ".5 ", _s(size % 13), ".25 ", _s(40 + size), " ", _s(size % 4), " ", s._image_name(pk, size))
    point_of = F.when(F.col("l_returnflag") == "R", F.lit("-1")).otherwise(_s(F.col("l_orderkey")))
    sighting = _text(_s(F.col("l_quantity") * 40), ".5 ", _s(F.col("l_linenumber")), " ", point_of)
    sightings = s.table("lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_linenumber", F.col("l_quantity").alias("q"), sighting.alias("t")).groupBy("p_partkey").agg(
        F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber", "q", "t"))).alias("seen"))
    line = F.coalesce(F.concat_ws(" ", F.transform("seen", lambda e: e["t"])), F.lit("0.5 0 -1"))
    parts = s.table("part").join(sightings, "p_partkey", "left").withColumn("at", pk).withColumn("obs", F.when(F.col("seen").isNull(), "0.5 0 -1").otherwise(line))
    images = _several(
        parts, ["at"], (pk % 9 == 0, _text(_s(pk), " 0 1 0 0 9 9 9 9 stale.jpg")), (pk % 9 == 0, F.lit("1 1 5")), (True, pose), (pk % 14 == 5, F.lit("# between")),
        (True, _text(F.col("obs"), F.when(pk % 10 == 3, " 7 8").otherwise(""))), (pk % 15 == 4, F.lit("a stray line")))
    _put(images.unionByName(s.spark.createDataFrame([(-1, 0, "# Image list")], "at bigint, part int, line string")), f"{root}/images.txt", ["at", "part"], n_files)

    sk = F.col("s_suppkey")
    camera = _text(_s(sk), " ", F.when(sk % 2 == 0, "PINHOLE").otherwise("OPENCV"), " ", _s(1000 + sk), " ", _s(700 + F.col("s_nationkey")), " ", _s(sk % 90 + 1000), ".5 ",
                   _s(sk % 70), " -", _s(sk % 50 + 1))
    _put(_several(s.table("supplier").withColumn("at", sk), ["at"], (sk % 8 == 0, _text(_s(sk), " PINHOLE 1 1 1")), (True, camera)), f"{root}/cameras.txt", ["at", "part"])
    return root


def write_nav(s: Survey) -> str:
    """Two nav files of other delimiters, columns and spellings, with repeated names and an unreadable row here and there."""
    root = scratch_path(s.spark, "nav")
    ck, east = F.col("c_custkey"), F.floor(F.col("c_acctbal"))
    rows = s.table("customer").withColumn("at", ck)
    x = F.when(ck % 50 == 0, "oops").otherwise(_text(_s(east), ".0"))
    first = _several(rows.filter(ck % 2 == 0), ["at"], (ck % 20 == 2, _text("img", _s(ck), ".jpg,1,1,1")), (True, _text('"img', _s(ck), '.jpg",', x, ",", _s(ck), ",-", _s(ck % 40), ".5")))
    second = _several(rows.filter(ck % 2 == 1), ["at"], (True, _text(_s(ck % 360), ";img", _s(ck), ".jpg;", _s(ck % 90), ".25;", x, "; 80;-1")), (ck % 7 == 0, F.lit("  ")))
    for name, head, lines in (("a", "filename,X (East),Y (North),Alt", first), ("b", "Yaw;name;lat;lon;Pitch;Roll", second)):
        _put(lines.unionByName(s.spark.createDataFrame([(-1, 0, head)], "at bigint, part int, line string")), f"{root}/{name}", ["at", "part"])
    return f"{root}/*"


def write_rules(s: Survey) -> str:
    """Camera rules, one per nation; every sixth line is too short to count."""
    nk, names = F.col("n_nationkey"), F.array(*map(F.lit, ["OPENCV", "pinhole", "OPENCV_FISHEYE"]))
    line = F.when(nk % 6 == 5, _text(F.col("n_name"), ";OPENCV")).otherwise(_text(F.col("n_name"), "; ", F.get(names, (nk % 3).cast("int")), " ;", _s(nk + 10), ".5;36"))
    lines = _several(s.table("nation").withColumn("at", nk), ["at"], (nk % 4 == 0, F.lit("# a rule")), (True, line))
    return _put(lines, scratch_path(s.spark, "rules"), ["at", "part"])


def write_metric_log(s: Survey) -> str:
    return _put(s.metric_lines(), scratch_path(s.spark, "metrics"), ["line_no"], _files(s.table("events")))


def write_gpu_log(s: Survey) -> str:
    n = F.col("event_id")
    line = _text(F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"), ",", F.col("event_type"), ",", _s(n % 9000), ",", _s(n % 70), ",32607")
    lines = _several(s.table("events").withColumn("at", n), ["at"], (n % 100 == 0, F.lit("timestamp,label,used_mib,free_mib,total_mib")), (True, line))
    return _put(lines, scratch_path(s.spark, "gpu"), ["at", "part"], _files(s.table("events")))


def write_stage_logs(s: Survey) -> str:
    """One log per run, its events as lines; markers of stages and elapsed times stand far apart."""
    root, n, kind = scratch_path(s.spark, "logs"), F.col("event_id"), F.col("event_type")
    line = F.when((kind == "view") & (n % 3 == 0), "=== Feature matching (spatial) ===").when((kind == "click") & (n % 10 < 5), "Running rotation averaging ...").otherwise(_text("step ", _s(n)))
    events = s.table("events").withColumns({"at": n, "run": F.col("user_id") % 10})
    lines = _several(events, ["at", "run"], (True, line), ((n % 97 == 0) & (F.col("run") != 3), _text("Elapsed time: ", _s(n % 500), ".25 [minutes]")))
    lines.repartition("run").sortWithinPartitions("run", "at", "part").select("run", "line").write.partitionBy("run").text(root)
    return root
