"""Appearance of Gaussian splats: opacity, size and colour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: degree-0 spherical-harmonic basis constant, 1 / (2 sqrt(pi)).
SH_C0 = 0.28209479177387814

# Names of the 24 hue bins of 15 degrees, from 0 to 360.
HUE_LABELS = [
    "Red", "Red-Org", "Orange", "Org-Yel",
    "Yellow", "Yel-Grn", "Green", "Grn-Cyn",
    "Cyan", "Cyn-Cyn", "Cyn-Blu", "Lt Blue",
    "Blue", "Blu-Blu", "Indigo", "Violet",
    "Purple", "Magenta", "Pink", "Pink-Red",
    "Red2", "Red2+", "Red3", "Red3+",
]


def opacity(logit: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-logit.cast("double")))


def max_scale(scales: list[Column]) -> Column:
    """Largest extent from three log-scale columns."""
    return F.greatest(*[F.exp(c.cast("double")) for c in scales[:3]])


def sh_rgb(coefficient: Column) -> Column:
    """One colour channel in 0..1 from its degree-0 coefficient."""
    return F.least(F.greatest(coefficient.cast("double") * SH_C0 + 0.5, F.lit(0.0)), F.lit(1.0))


def hsv(r: Column, g: Column, b: Column) -> Column:
    """Struct ``(h, s, v)``, hue in degrees; on ties blue wins over green over red."""
    high, low = F.greatest(r, g, b), F.least(r, g, b)
    delta = high - low
    sector = (
        F.when(high == b, (r - g) / delta + 4.0)
        .when(high == g, (b - r) / delta + 2.0)
        .otherwise(F.pmod((g - b) / delta, F.lit(6.0)))
    )
    # Every sector is at least 0, so the hue needs no wrap.
    return F.struct(
        F.when(delta > 1e-8, 60.0 * sector).otherwise(0.0).alias("h"),
        F.when(high > 0, delta / high).otherwise(0.0).alias("s"),
        high.alias("v"),
    )


def hue_between(h: Column, lo: float, hi: float) -> Column:
    """Inclusive hue range; ``lo > hi`` wraps through zero."""
    return (h >= lo) & (h <= hi) if lo <= hi else (h >= lo) | (h <= hi)
