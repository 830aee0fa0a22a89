"""File names, camera tags, model codes and stage labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File suffixes that mark an image.
IMAGE_EXTENSIONS = ["jpg", "jpeg", "png", "tif", "tiff", "bmp"]

# Camera model codes stored in survey databases.
CAMERA_MODELS = {
    "SIMPLE_PINHOLE": 0,
    "PINHOLE": 1,
    "SIMPLE_RADIAL": 2,
    "RADIAL": 3,
    "OPENCV": 4,
    "OPENCV_FISHEYE": 5,
    "FULL_OPENCV": 6,
    "SIMPLE_RADIAL_FISHEYE": 8,
    "RADIAL_FISHEYE": 9,
}

# Camera tags searched in image names, in this order.
CAMERA_TAGS = ["HERC", "camlower", "cammid", "camupper"]

# Header spellings accepted for each nav column.
NAV_ALIASES = {
    "name": ["filename", "image_name", "image", "name", "file"],
    "x": ["x (east)", "easting", "x_east", "utm_e", "east"],
    "y": ["y (north)", "northing", "y_north", "utm_n", "north"],
    "lat": ["lat", "latitude"],
    "lon": ["lon", "lng", "longitude"],
    "alt": ["alt", "altitude", "depth", "z", "elevation"],
    "yaw": ["yaw"],
    "pitch": ["pitch"],
    "roll": ["roll"],
    "x_acc": ["x accuracy", "x_accuracy"],
    "y_acc": ["y accuracy", "y_accuracy"],
    "alt_acc": ["alt accuracy", "alt_accuracy"],
}

# Log markers and the stage each one names; the first hit wins.
STAGE_MARKERS = [
    (r"=== Feature extraction ===", "Feature Extraction"),
    (r"=== Feature matching", "Feature Matching"),
    (r"Running rotation averaging", "Global Mapper"),
    (r"Registering image", "Incremental Mapper"),
    (r"=== Image undistortion", "Image Undistortion"),
    (r"patch_match", "PatchMatch Stereo"),
    (r"stereo_fusion", "Stereo Fusion"),
    (r"Loading descriptors.*Building index", "Vocab Tree Building"),
]

# Pipeline stages in running order.
STAGE_ORDER = [
    "INITIALIZING", "FEATURE_EXTRACTION", "CAMERA_ASSIGNMENT", "MATCHING",
    "RECONSTRUCTION", "DENSE_RECONSTRUCTION", "COMPLETE",
]

# Patterns of the metrics in training logs.
METRIC_PATTERNS = {
    "iteration": r"iter[ation]*\s*[\[: ]*(\d+)",
    "total_iterations": r"(?:iterations|total_iter|max_iter)[=: ]*(\d+)",
    "loss": r"loss[=: ]*([0-9]+\.[0-9]+)",
    "psnr": r"[Pp][Ss][Nn][Rr][=: ]*([0-9]+\.[0-9]+)",
    "ssim": r"[Ss][Ss][Ii][Mm][=: ]*([0-9]+\.[0-9]+)",
    "gaussians": r"(?:gaussians|splats|num_points)[=: ]*([0-9,]+)",
    "it_per_sec": r"(?:iter/s|it/s)[=: ]*([0-9]+\.?[0-9]*)",
}
ELAPSED_PATTERN = r"Elapsed time: ([\d.]+) \[minutes\]"

WGS84, CARTESIAN = 0, 1


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^./]*$", "")


def extension(name: Column) -> Column:
    return F.regexp_extract(name, r"\.([^./]*)$", 1)


def swap_ext(name: Column, old: str, new: str) -> Column:
    return F.regexp_replace(name, rf"\.{old}$", f".{new}")


def is_image_name(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).isin(*IMAGE_EXTENSIONS)


def is_pose_line(parts: Column) -> Column:
    """Ten or more fields, integers at 0 and 8, an image file name at 9."""
    integer = r"^[+-]?\d+$"
    return F.coalesce(
        (F.size(parts) >= 10)
        & F.get(parts, F.lit(0)).rlike(integer)
        & F.get(parts, F.lit(8)).rlike(integer)
        & is_image_name(F.get(parts, F.lit(9))),
        F.lit(False),
    )


def camera_tag(name: Column) -> Column:
    known = F.when(F.lit(False), F.lit(None).cast("string"))
    for tag in CAMERA_TAGS:
        known = known.when(name.contains(tag), tag)
    return known.when(name.contains("_"), F.substring_index(name, "_", 1)).otherwise("unknown")


def model_name(code: Column) -> Column:
    """Model name of a code; ``UNKNOWN(n)`` for others."""
    known = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, number in CAMERA_MODELS.items():
        known = known.when(code == number, name)
    return known.otherwise(F.concat(F.lit("UNKNOWN("), code.cast("string"), F.lit(")")))


def model_code(name: Column) -> Column:
    known = F.when(F.lit(False), F.lit(None).cast("int"))
    for label, number in CAMERA_MODELS.items():
        known = known.when(name == label, number)
    return known


def canonical_columns(header: list[str]) -> dict[str, str]:
    """Map canonical nav names to the header fields that spell them; the last one wins."""
    spelling = {alias: name for name, aliases in NAV_ALIASES.items() for alias in aliases}
    cleaned = [(spelling.get(field.strip().lower()), field) for field in header]
    return {name: field for name, field in cleaned if name}


def coord_system(columns: dict[str, str], explicit: int | None = None) -> int:
    """Explicit code, else cartesian for projected input, else WGS84."""
    if explicit is not None:
        return explicit
    return CARTESIAN if {"x", "y"} <= set(columns) else WGS84


def log_stage(content: Column) -> Column:
    """Label of the first stage marker found in a log."""
    label = F.when(F.lit(False), F.lit(None).cast("string"))
    for pattern, name in STAGE_MARKERS:
        label = label.when(content.rlike(f"(?i){pattern}"), name)
    return label.otherwise("Unknown Stage")


def elapsed_minutes(content: Column) -> Column:
    """Minutes from the elapsed-time line; NULL when the log has none."""
    return F.regexp_extract(content, ELAPSED_PATTERN, 1).try_cast("double")


def stage_progress(stage: Column) -> Column:
    """Percent of the ordered stage list reached; 0 for unknown stages."""
    order = F.array(*[F.lit(s) for s in STAGE_ORDER])
    index = F.array_position(order, stage) - 1
    pct = F.floor(index * 100.0 / (len(STAGE_ORDER) - 1) + 0.5).cast("bigint")
    return F.when(index < 0, F.lit(0).cast("bigint")).otherwise(pct)


def metric(line: Column, name: str) -> Column:
    """Last value of one metric on a log line; NULL when the line has none."""
    found = F.regexp_extract_all(line, F.lit(METRIC_PATTERNS[name]), F.lit(1))
    last = F.try_element_at(found, F.lit(-1))
    return F.regexp_replace(last, ",", "").try_cast("double")
