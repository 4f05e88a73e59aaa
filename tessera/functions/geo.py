"""Geographic column expressions on degrees of latitude and longitude."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.cleaning import ColumnOrName, _col

# Fixed value: mean radius of the earth in km.
EARTH_KM = 6371.0088


def haversine_km(lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName) -> Column:
    """Great-circle distance; NULL if any coordinate is."""
    a, b = F.radians(_col(lat1)), F.radians(_col(lat2))
    half = (b - a) / 2
    across = F.radians(_col(lon2) - _col(lon1)) / 2
    chord = F.sin(half) * F.sin(half) + F.cos(a) * F.cos(b) * F.sin(across) * F.sin(across)
    # Rounding may go beyond 1; least() would turn NULL into 1.
    return 2 * EARTH_KM * F.asin(F.when(chord > 1, 1.0).otherwise(F.sqrt(chord)))


def manhattan_km(lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName) -> Column:
    """Along the meridian of the first place, then along the parallel of the second."""
    return haversine_km(lat1, lon1, lat2, lon1) + haversine_km(lat2, lon1, lat2, lon2)


def bearing(lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName) -> Column:
    """Initial direction from the first place to the second, in degrees from north, 0 to 360."""
    a, b, across = F.radians(_col(lat1)), F.radians(_col(lat2)), F.radians(_col(lon2) - _col(lon1))
    degrees = F.degrees(F.atan2(F.sin(across) * F.cos(b), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(across)))
    return (degrees + 360.0) % 360.0


def in_box(lat: ColumnOrName, lon: ColumnOrName, south: float, west: float, north: float, east: float) -> Column:
    """Whether a place lies in an area, borders included; ``west > east`` spans the date line."""
    x = _col(lon)
    wide = x.between(west, east) if west <= east else (x >= west) | (x <= east)
    return _col(lat).between(south, north) & wide
