"""Distances, grid cells and tiles as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Metres per degree, of latitude and (one for all places) of longitude; the earth's radius in metres.
LAT_M, LNG_M, RADIUS_M = 111_320.0, 62_500.0, 6_371_000.0


def planar_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column, by_latitude: bool = False) -> Column:
    """Distance in a plane; with ``by_latitude`` the longitude's scale follows the latitude."""
    scale = F.lit(LAT_M) * F.cos(F.radians((lat1 + lat2) / 2)) if by_latitude else F.lit(LNG_M)
    y, x = (lat1 - lat2) * LAT_M, (lng1 - lng2) * scale
    return F.sqrt(y * y + x * x)


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    a, b = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lng2 - lng1) / 2)
    return 2 * RADIUS_M * F.asin(F.least(F.lit(1.0), F.sqrt(a * a + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * b * b)))


def tile(lat: Column, lng: Column, zoom: int = 14) -> Column:
    """Struct (x, y) of the web map tile."""
    n = float(1 << zoom)
    rad = F.radians(lat)
    x = F.floor((lng + 180) / 360 * n).cast("int")
    y = F.floor((1 - F.ln(F.tan(rad) + 1 / F.cos(rad)) / F.lit(3.141592653589793)) / 2 * n).cast("int")
    return F.struct(x.alias("x"), y.alias("y"))


def cell(v: Column, size: float = 0.01) -> Column:
    """Number of the grid cell whose middle is nearest."""
    return F.floor(v / size + 0.5).cast("long")


def segment_m(lat: Column, lng: Column, lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Planar distance from a point to a line between two points, ends included."""
    px, py = (lng - lng1) * LNG_M, (lat - lat1) * LAT_M
    dx, dy = (lng2 - lng1) * LNG_M, (lat2 - lat1) * LAT_M
    span = dx * dx + dy * dy
    t = F.when(span == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (px * dx + py * dy) / span)))
    ex, ey = px - t * dx, py - t * dy
    return F.sqrt(ex * ex + ey * ey)


def in_box(lat: Column, lng: Column, box: tuple[float, float, float, float] | None, order: str = "swne") -> Column:
    """Inside a box, borders included. ``order`` is 'swne' or 'wsen'; no box, or one with a missing side, lets all pass."""
    if box is None or any(v is None or v != v for v in box):
        return F.lit(True)
    s, w, n, e = box if order == "swne" else (box[1], box[0], box[3], box[2])
    return lat.between(s, n) & lng.between(w, e)


def boxes_meet(w1: Column, s1: Column, e1: Column, n1: Column, box: tuple[float, float, float, float]) -> Column:
    """Whether a row's box overlaps ``box`` (w, s, e, n)."""
    w, s, e, n = box
    return (w1 <= e) & (e1 >= w) & (s1 <= n) & (n1 >= s)


def parse_box(text: Column) -> Column:
    """Array of four numbers from "a,b,c,d"; null if it isn't one."""
    parts = F.transform(F.split(text, ","), lambda p: F.trim(p).try_cast("double"))
    return F.when((F.size(parts) == 4) & ~F.exists(parts, lambda p: p.isNull() | F.isnan(p)), parts)


def padded(box: Column, share: float = 0.03, degrees: float = 0.002) -> Column:
    """A box [w, s, e, n], wider by a share of its sides and some degrees."""
    w, s, e, n = (box[i] for i in range(4))
    x, y = (e - w) * share + degrees, (n - s) * share + degrees
    return F.array(w - x, s - y, e + x, n + y)


def box_overlap(a: Column, b: Column) -> Column:
    """Intersection over union of two boxes [w, s, e, n]."""
    width = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    height = F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    both = width * height
    area = lambda x: (x[2] - x[0]) * (x[3] - x[1])
    union = area(a) + area(b) - both
    return F.when(union > 0, both / union).otherwise(0.0)
