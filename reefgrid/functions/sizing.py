"""Ratios, resource estimates and camera parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the GPU memory and run-time model.
VRAM_TOTAL_GB = 32.0
VRAM_OVERHEAD_GB = 2.0
VRAM_USABLE_GB = VRAM_TOTAL_GB - VRAM_OVERHEAD_GB
TRAINING_OVERHEAD_GB = 1.5
BYTES_PER_GAUSSIAN = 760
RENDER_BYTES_PER_PIXEL = 48
GIB = 1024.0**3

# Preset -> (iterations, cap multiplier, resize factor, share of usable memory).
PRESETS = {
    "preview": (3000, 1.0, 4, 0.80),
    "medium": (7000, 1.5, 2, 0.85),
    "high": (30000, 2.0, 2, 0.90),
    "max-quality": (30000, 3.0, 1, 0.92),
}


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, 0 when the whole is 0."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part * 100.0 / whole)


def hectares(area_m2: Column) -> Column:
    return area_m2 / 10000.0


def focal_px(focal_mm: Column, width: Column, sensor_mm: Column) -> Column:
    return focal_mm * width / sensor_mm


def camera_params(model: Column, focal: Column, width: Column, height: Column) -> Column:
    """Initial parameter vector of a camera model, distortion at zero."""
    cx, cy, zero = width / 2.0, height / 2.0, F.lit(0.0)
    one_focal = [focal, cx, cy]
    two_focals = [focal, focal, cx, cy]
    return (
        F.when(model == "PINHOLE", F.array(*two_focals))
        .when(model == "SIMPLE_RADIAL", F.array(*one_focal, zero))
        .when(model == "RADIAL", F.array(*one_focal, zero, zero))
        .when(model.isin("OPENCV", "OPENCV_FISHEYE"), F.array(*two_focals, *[zero] * 4))
        .otherwise(F.array(*one_focal))
    )


def render_gb(width: Column, height: Column, resize: Column) -> Column:
    return (width / resize) * (height / resize) * RENDER_BYTES_PER_PIXEL / GIB


def est_vram(cap: Column, width: Column, height: Column, resize: Column) -> Column:
    """Peak training memory in GB."""
    fixed = VRAM_OVERHEAD_GB + TRAINING_OVERHEAD_GB
    return F.lit(fixed) + render_gb(width, height, resize) + cap * BYTES_PER_GAUSSIAN / GIB


def max_cap(width: Column, height: Column, resize: Column, target_gb: Column) -> Column:
    """Gaussians that fit a memory budget; 0 when nothing does."""
    free = target_gb - (VRAM_OVERHEAD_GB + TRAINING_OVERHEAD_GB) - render_gb(width, height, resize)
    return F.when(free <= 0, F.lit(0)).otherwise(F.floor(free * GIB / BYTES_PER_GAUSSIAN)).cast("bigint")


def est_minutes(iterations: Column, cap: Column, width: Column, height: Column, resize: Column) -> Column:
    """Training minutes from the power-law fit."""
    pixels = (width / resize) * (height / resize) / 1e6
    ms = 3 + 22 * F.pow(cap / 1e6, F.lit(0.8)) * F.pow(pixels, F.lit(0.5))
    return iterations * ms / 60000.0


def scene_need(points: Column, images: Column, multiplier: Column) -> Column:
    """Gaussians a scene is likely to use: points, else images x 300."""
    base = F.when(points > 0, points).otherwise(F.greatest(images, F.lit(1)) * 300)
    return F.floor(base * multiplier).cast("bigint")


def scene_cap(points: Column, images: Column, multiplier: Column, vram_limit: Column) -> Column:
    """Scene need within the memory budget, in steps of 100 000 and at least one step."""
    raw = F.least(scene_need(points, images, multiplier), vram_limit)
    step = 100000
    return F.greatest(F.lit(step).cast("bigint"), (F.floor(raw / step) * step).cast("bigint"))


def vram_band(vram_gb: Column) -> Column:
    used = F.least(vram_gb / VRAM_TOTAL_GB, F.lit(1.0))
    return (
        F.when(used > 0.95, "DANGER").when(used > 0.85, "TIGHT").when(used > 0.70, "OK").otherwise("SAFE")
    )


def keep_components(points: Column) -> Column:
    """How many clusters to keep for a cloud of this size."""
    return F.when(points > 10_000_000, 15).when(points > 5_000_000, 10).otherwise(5)


def est_db_gb(images: Column, features: Column) -> Column:
    return F.floor(images * features * 128 * 2 / GIB).cast("bigint")


def est_desc_gb(descriptors: Column) -> Column:
    """Working memory of descriptor clustering, raw bytes plus half."""
    return F.floor(F.floor(descriptors * 128 / GIB) * 3 / 2).cast("bigint")


def eta_seconds(total: Column, last: Column, per_second: Column) -> Column:
    return F.try_divide((total - last).cast("double"), per_second)


def eta_text(seconds: Column) -> Column:
    """Hours with one decimal, whole minutes or whole seconds."""
    return (
        F.when(seconds > 3600, F.format_string("%.1fh", seconds / 3600))
        .when(seconds > 60, F.format_string("%.0fm", seconds / 60))
        .when(seconds.isNotNull(), F.format_string("%.0fs", seconds))
    )
