"""Great-circle distance, bounding boxes and grid cells as native column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitescout.settings import SETTINGS

EARTH_KM = SETTINGS.earth_radius_km

# Boxes are widened by this many degrees (about 1 cm), so rounding never loses a true hit.
BOX_MARGIN = 1e-7


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance by the spherical law of cosines."""
    return distance_from_parts(trig_parts(lat1, lon1), trig_parts(lat2, lon2))


def trig_parts(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """(sine of latitude, cosine of latitude, longitude in radians): what a point brings to a
    distance. A join that tests many pairs works them out once per point, not per pair."""
    return F.sin(F.radians(lat)), F.cos(F.radians(lat)), F.radians(lon)


def distance_from_parts(
    first: tuple[Column, Column, Column], second: tuple[Column, Column, Column]
) -> Column:
    """Distance of two points given by their ``trig_parts``.

    The cosine is clamped: rounding can push it past 1, where acos gives NaN and a business
    standing exactly on the site would be lost.
    """
    (sin1, cos1, lon1), (sin2, cos2, lon2) = first, second
    cosine = cos1 * cos2 * F.cos(lon2 - lon1) + sin1 * sin2
    return F.lit(EARTH_KM) * F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))


def lat_reach(km: Column) -> Column:
    """Degrees of latitude that ``km`` can span; what is further north or south is too far."""
    return F.degrees(km / EARTH_KM) + BOX_MARGIN


def bounding_box(lat: float, lon: float, km: float) -> tuple[float, float, list[tuple[float, float]]]:
    """(south, north, longitude ranges) around a point: two ranges if the box crosses ±180°."""
    angle = km / EARTH_KM
    reach = math.degrees(angle) + BOX_MARGIN
    south, north = lat - reach, lat + reach
    if south <= -90 or north >= 90:
        return max(south, -90.0), min(north, 90.0), [(-180.0, 180.0)]
    side = math.degrees(math.asin(min(1.0, math.sin(angle) / math.cos(math.radians(lat)))))
    side += BOX_MARGIN
    west, east = lon - side, lon + side
    if east - west >= 360:
        return south, north, [(-180.0, 180.0)]
    if west < -180:
        return south, north, [(west + 360, 180.0), (-180.0, east)]
    if east > 180:
        return south, north, [(west, 180.0), (-180.0, east - 360)]
    return south, north, [(west, east)]


def inside_box(lat: Column, lon: Column, site_lat: float, site_lon: float, km: float) -> Column:
    """The box around a site as plain comparisons on stored columns, which reach the scan."""
    south, north, ranges = bounding_box(site_lat, site_lon, km)
    in_range = [lon.between(west, east) for west, east in ranges]
    wanted = in_range[0]
    for other in in_range[1:]:
        wanted = wanted | other
    return lat.between(south, north) & wanted


def _lon_cells(degrees: float) -> int:
    """Cells around the globe. They are of equal width, so that they also meet at ±180°."""
    return math.ceil(360 / degrees)


def _cell_id(lat_cell: Column, lon_cell: Column, degrees: float) -> Column:
    return lat_cell * F.lit(_lon_cells(degrees)) + lon_cell


def _lat_cell(lat: Column, degrees: float) -> Column:
    return F.floor((lat + 90) / degrees)


def _lon_cell(lon: Column, degrees: float) -> Column:
    return F.floor((lon + 180) / (360 / _lon_cells(degrees)))


def grid_cell(lat: Column, lon: Column, degrees: float = SETTINGS.cell_degrees) -> Column:
    """The cell a point lies in."""
    wrapped = F.pmod(_lon_cell(lon, degrees), F.lit(_lon_cells(degrees)))
    return _cell_id(_lat_cell(lat, degrees), wrapped, degrees)


def covering_cells(
    lat: Column, lon: Column, km: Column, degrees: float = SETTINGS.cell_degrees
) -> Column:
    """Array of the cells that a circle around (lat, lon) can touch, each once."""
    angle = km / EARTH_KM
    south, north = lat - lat_reach(km), lat + lat_reach(km)
    has_pole = (south <= -90) | (north >= 90)
    half_width = F.degrees(F.asin(F.least(F.lit(1.0), F.sin(angle) / F.cos(F.radians(lat)))))
    half_width = F.when(has_pole, F.lit(180.0)).otherwise(half_width + BOX_MARGIN)
    lon_cells = F.lit(_lon_cells(degrees))

    rows = F.sequence(
        _lat_cell(F.greatest(south, F.lit(-90.0)), degrees),
        _lat_cell(F.least(north, F.lit(90.0)), degrees),
    )
    first, last = _lon_cell(lon - half_width, degrees), _lon_cell(lon + half_width, degrees)
    columns = F.when(
        last - first + 1 >= lon_cells, F.sequence(F.lit(0).cast("long"), (lon_cells - 1).cast("long"))
    ).otherwise(F.transform(F.sequence(first, last), lambda c: F.pmod(c, lon_cells)))
    return F.flatten(
        F.transform(rows, lambda r: F.transform(columns, lambda c: _cell_id(r, c, degrees)))
    )
