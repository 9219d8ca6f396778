import math
import random

import pytest
from pyspark.sql import functions as F

from textloom.functions import geo
from textloom.operators.completion import geo_cell, near_cells


def metres(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((a - c) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((b - d) / 2) ** 2
    return 2 * geo.EARTH_RADIUS_M * math.asin(math.sqrt(min(1.0, h)))


def test_the_box_loses_no_point(spark):
    rng = random.Random(2)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(3000)]
    points += [(rng.uniform(-10, 10), rng.choice((-180.0, 180.0, -179.9, 179.9, 0.0, 190.0, -185.0))) for _ in range(200)] + [(90.0, 12.0), (-90.0, -7.0)]
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(points)], "i int, p struct<lat:double,lon:double>").cache()
    circles = [(0.0, 179.5, 9e5), (3.0, -179.0, 2e6), (48.5, 2.25, 4.5e6), (80.0, 30.0, 2e6), (-89.0, 0.0, 5e5), (60.0, 100.0, 3e6), (0.0, 0.0, 1.2e7), (10.0, 20.0, 0.0)]
    tests = [geo.within(F.col("p"), *c).alias(f"c{k}") for k, c in enumerate(circles)]
    for r in frame.select("i", *tests).collect():
        for k, (lat, lon, m) in enumerate(circles):
            far = metres(*points[r["i"]], lat, lon)
            assert r[f"c{k}"] == (far <= m) or abs(far - m) < 1e-3, (points[r["i"]], circles[k])


def test_ranges_of_longitude():
    assert geo.longitudes(89.0, 0.0, 2e5) is None and len(geo.longitudes(0.0, 179.9, 1e5)) == 2 and len(geo.longitudes(0.0, -179.9, 1e5)) == 2
    ((west, east),) = geo.longitudes(60.0, 10.0, 1e5)
    assert west < 10 - 1.79 and east > 10 + 1.79 and east - west < 3.7


@pytest.mark.parametrize("size", [30.0, 50.0, 7.3])
def test_cells_around_a_point_hold_all_near_points(spark, size):
    rng = random.Random(8)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(150)]
    points += [(rng.uniform(-90, 90), rng.choice((-180.0, 180.0, 179.99, -179.99, 150.0, -150.0))) for _ in range(60)] + [(90.0, 0.0), (-90.0, 0.0)]
    frame = spark.createDataFrame(points, "lat double, lon double")
    rows = frame.select("lat", "lon", geo_cell(F.col("lat"), F.col("lon"), size).alias("cell"), near_cells(F.col("lat"), F.col("lon"), size).alias("near")).collect()
    for a in rows:
        assert a["cell"] in a["near"] and len(a["near"]) == len(set(a["near"])) <= 15
        for b in rows:
            apart = abs(a["lon"] - b["lon"])
            if abs(a["lat"] - b["lat"]) <= size and min(apart, 360 - apart) <= size:
                assert b["cell"] in a["near"]
    nothing = spark.range(1).select(near_cells(F.lit(None).cast("double"), F.lit(1.0), size).alias("near"))
    assert nothing.first()["near"] is None
