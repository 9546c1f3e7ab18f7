"""Great-circle distance and its bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius (km) and the band limits (km).
EARTH_RADIUS_KM = 6371.0
SHORT_HAUL_BELOW_KM = 1500
MEDIUM_HAUL_BELOW_KM = 3500


def _half_chord(angle: Column) -> Column:
    return F.pow(F.sin(angle / 2), F.lit(2))


def distance_km(lat_1: Column, lon_1: Column, lat_2: Column, lon_2: Column) -> Column:
    """Haversine distance; NULL as soon as one coordinate is NULL.

    The arcsine argument is held at 1 so that rounding at opposite points of the globe cannot give NaN.
    """
    phi_1, phi_2 = F.radians(lat_1), F.radians(lat_2)
    h = _half_chord(phi_2 - phi_1) + F.cos(phi_1) * F.cos(phi_2) * _half_chord(F.radians(lon_2) - F.radians(lon_1))
    # least() skips NULLs, so the NULL rule has to be stated.
    known = lat_1.isNotNull() & lon_1.isNotNull() & lat_2.isNotNull() & lon_2.isNotNull()
    return F.when(known, 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(F.lit(1.0), h))))


def distance_category(km: Column) -> Column:
    return (
        F.when(km < SHORT_HAUL_BELOW_KM, "short_haul")
        .when(km < MEDIUM_HAUL_BELOW_KM, "medium_haul")
        .when(km.isNotNull(), "long_haul")
    )
