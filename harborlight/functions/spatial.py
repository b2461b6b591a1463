"""Points, boxes and metres on the WGS84 ellipsoid, in column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AXIS, ECCENTRICITY2 = 6378137.0, 0.00669437999014
#: The service area in degrees (x least, x most, y least, y most).
BOX = (128.85, 129.35, 34.95, 35.45)


def point(x: Column, y: Column) -> Column:
    """Struct of both coordinates, null unless both exist (PRJ-44)."""
    return F.when(x.isNotNull() & y.isNotNull(), F.struct(x.alias("x"), y.alias("y")))


def in_box(x: Column, y: Column, box: tuple[float, float, float, float] = BOX) -> Column:
    """Whether a point lies in the box (PRJ-37)."""
    return x.between(box[0], box[1]) & y.between(box[2], box[3])


def metres(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance of near points: the ellipsoid's curvature radii at the middle latitude (SIM-12)."""
    middle = F.radians((y1 + y2) / 2)
    w = 1 - ECCENTRICITY2 * F.sin(middle) * F.sin(middle)
    along = F.radians(y2 - y1) * (AXIS * (1 - ECCENTRICITY2)) / (w * F.sqrt(w))
    across = F.radians(x2 - x1) * AXIS * F.cos(middle) / F.sqrt(w)
    return F.sqrt(along * along + across * across)


def band(y: Column, radius: float | Column) -> Column:
    """Latitude band at least radius metres high."""
    return F.floor(y / (radius / 110574.0))


def _widest(in_band: Column, radius: float | Column, reach: int) -> Column:
    """Degrees of longitude of a cell of a band."""
    most = F.greatest(F.abs(in_band - reach), F.abs(in_band + 1 + reach)) * (radius / 110574.0)
    across = F.radians(F.lit(1.0)) * AXIS * F.cos(F.radians(F.least(most, F.lit(90.0))))
    return F.least(radius / F.greatest(across, F.lit(1e-9)), F.lit(720.0))


def cell(x: Column, in_band: Column, radius: float | Column, reach: int = 1) -> Column:
    """Longitude cell within a band, at least radius metres wide wherever the band or the `reach` bands on both sides lie."""
    return F.floor(x / _widest(in_band, radius, reach))


def span(in_band: Column, radius: float | Column, reach: int = 1) -> Column:
    """Metres that a point of a cell and one of the nine cells around it are apart at most; null near the poles, where cells widen without bound."""
    high = F.lit(radius) / 110574.0
    low = F.when((in_band <= 1) & (in_band >= -2), 0.0).otherwise(F.least(F.abs(in_band - 1), F.abs(in_band + 2)) * high)
    along = F.radians(2 * high) * (AXIS / (1 - ECCENTRICITY2) ** 0.5)
    across = F.radians(2 * _widest(in_band, radius, reach)) * (AXIS / (1 - ECCENTRICITY2) ** 0.5) * F.cos(F.radians(low))
    # A part in a thousand stands for rounding.
    return F.when(F.greatest(F.abs(in_band - 1), F.abs(in_band + 2)) * high < 89, F.sqrt(along * along + across * across) * 1.001)
