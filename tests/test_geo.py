"""Distances and directions against known values."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import geo


@pytest.mark.parametrize("way, km, degrees", [
    ((48.8566, 2.3522, 51.5074, -0.1278), 343.56, 330.0), ((0.0, 0.0, 0.0, 180.0), 20015.11, 90.0), ((10.0, 20.0, 10.0, 20.0), 0.0, 0.0),
    ((0.0, 0.0, 90.0, 0.0), 10007.56, 0.0), ((0.0, 179.0, 0.0, -179.0), 222.39, 90.0)])
def test_known_distances(spark, way, km, degrees):
    columns = [F.lit(x) for x in way]
    r = spark.range(1).select(geo.haversine_km(*columns).alias("d"), geo.bearing(*columns).alias("b"), geo.manhattan_km(*columns).alias("m")).first()
    assert r.d == pytest.approx(km, abs=0.05) and r.b == pytest.approx(degrees, abs=0.3) and r.m >= r.d - 1e-9


def test_areas_and_nulls(spark):
    inside = lambda lat, lon, *box: spark.range(1).select(geo.in_box(F.lit(lat), F.lit(lon), *box)).first()[0]
    assert inside(1.0, 2.0, 0, 0, 1, 2) and not inside(1.1, 2.0, 0, 0, 1, 2)
    assert inside(0.0, 179.5, -1, 179, 1, -179) and inside(0.0, -179.5, -1, 179, 1, -179) and not inside(0.0, 0.0, -1, 179, 1, -179)
    assert spark.range(1).select(geo.haversine_km(F.lit(None).cast("double"), F.lit(0), F.lit(1), F.lit(1))).first()[0] is None
