"""Thresholds by speed band as CASE expressions, and classes by limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def by_band(speed: Column, bands: Sequence[tuple[float, float, float]], default: float) -> Column:
    """Value of the band with lo <= speed < hi."""
    out = F.lit(float(default))
    for lo, hi, value in reversed(bands):
        out = F.when((speed >= lo) & (speed < hi), float(value)).otherwise(out)
    return out


def by_floor(speed: Column, steps: dict[float, float], default: float, strict: bool = False) -> Column:
    """Value of the largest key that speed reaches (exceeds, if strict)."""
    out = F.lit(float(default))
    for key in sorted(steps):
        out = F.when(speed > key if strict else speed >= key, float(steps[key])).otherwise(out)
    return out


def by_ceiling(speed: Column, steps: Sequence[tuple[float, float]], default: float) -> Column:
    """Value of the first step with speed < key."""
    out = F.lit(float(default))
    for key, value in reversed(steps):
        out = F.when(speed < key, float(value)).otherwise(out)
    return out


def localization_class(status: Column, sd_east: Column, sd_north: Column, possible: float = 0.2, drift: float = 1.0) -> Column:
    sd = F.greatest(sd_east, sd_north)
    usable = status.isin(3, 7)
    return F.when(status == 2, "waiting").when(usable & (sd > drift), "drift").when(usable & (sd > possible), "possible").when(usable, "normal").otherwise("unknown")


def road_class(kappa: Column, bend: float = 0.003, sharp: float = 0.02) -> Column:
    k = F.abs(kappa)
    return F.when(k < bend, "straight").when(k < sharp, "small_curve").otherwise("large_curve")


def trusted(status: Column, sd_east: Column, sd_north: Column, most: float = 0.2) -> Column:
    """Whether a position can be used: a status, if there is one, of 3 or 7, and deviations, if both are there, within most."""
    return F.coalesce(status.isin(3, 7), F.lit(True)) & F.coalesce((F.greatest(sd_east, sd_north) <= most) | sd_east.isNull() | sd_north.isNull(), F.lit(True))


def valid_position(lat: Column, lon: Column) -> Column:
    return F.coalesce(~((lat == 0) & (lon == 0)) & (F.abs(lat) <= 90) & (F.abs(lon) <= 180), F.lit(False))
