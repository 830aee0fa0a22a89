"""Camera geometry as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rotmat(q: Column) -> list[list[Column]]:
    """3x3 rotation of the quaternion array ``(w, x, y, z)``, taken as given."""
    w, x, y, z = (q[i] for i in range(4))
    return [
        [1 - 2 * y * y - 2 * z * z, 2 * x * y - 2 * z * w, 2 * x * z + 2 * y * w],
        [2 * x * y + 2 * z * w, 1 - 2 * x * x - 2 * z * z, 2 * y * z - 2 * x * w],
        [2 * x * z - 2 * y * w, 2 * y * z + 2 * x * w, 1 - 2 * x * x - 2 * y * y],
    ]


def to_camera(q: Column, t: Column, x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """World position to camera frame, ``R p + t``."""
    rows = rotmat(q)
    cx, cy, cz = (r[0] * x + r[1] * y + r[2] * z + t[i] for i, r in enumerate(rows))
    return cx, cy, cz


def intrinsics(model: Column, params: Column) -> Column:
    """Struct ``(fx, fy, cx, cy)``; NULL for models other than the two pinholes."""
    simple = F.struct(
        params[0].alias("fx"), params[0].alias("fy"), params[1].alias("cx"), params[2].alias("cy")
    )
    full = F.struct(
        params[0].alias("fx"), params[1].alias("fy"), params[2].alias("cx"),
        F.get(params, F.lit(3)).alias("cy"),
    )
    return F.when(model == "SIMPLE_PINHOLE", simple).when(model == "PINHOLE", full)


def reproj_error(k: Column, cam_x: Column, cam_y: Column, cam_z: Column, px: Column, py: Column) -> Column:
    """Pixel distance between a projected point and its observation."""
    u = k["fx"] * cam_x / cam_z + k["cx"]
    v = k["fy"] * cam_y / cam_z + k["cy"]
    return F.sqrt((u - px) * (u - px) + (v - py) * (v - py))


def gravity(pitch: Column, roll: Column) -> Column:
    """Unit down vector in the camera frame from pitch and roll in degrees."""
    p, r = F.radians(pitch), F.radians(roll)
    g = [-F.sin(r) * F.cos(p), F.cos(r) * F.cos(p), F.sin(p)]
    norm = F.sqrt(g[0] * g[0] + g[1] * g[1] + g[2] * g[2])
    return F.when(pitch.isNotNull() & roll.isNotNull(), F.array(*[c / norm for c in g]))


def cov_diag(sx: Column, sy: Column, sz: Column) -> Column:
    """Row-major 3x3 covariance with squared accuracies on the diagonal."""
    zero = F.lit(0.0)
    return F.array(sx * sx, zero, zero, zero, sy * sy, zero, zero, zero, sz * sz)
