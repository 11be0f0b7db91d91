import math
import random

import pytest

from skyledger.config import Area
from skyledger.operators.area import within_area, within_box, within_disc


def miles(lat1, lon1, lat2, lon2):
    a, b, c, d = map(math.radians, (lat1, lon1, lat2, lon2))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * 3440.065 * math.asin(math.sqrt(h))


@pytest.mark.parametrize("lat,lon,radius", [(41.9, 12.5, 250), (0, 179.9, 300), (89, 0, 200), (-60, -179, 900), (10, 0, 9000)])
def test_disc_equals_brute_force(spark, lat, lon, radius):
    draw = random.Random(7)
    near = [(lat + draw.gauss(0, 5), lon + draw.gauss(0, 9)) for _ in range(400)]
    points = [(max(-90.0, min(90.0, a)), (b + 180) % 360 - 180) for a, b in near]
    points += [(draw.uniform(-90, 90), draw.uniform(-180, 180)) for _ in range(400)]
    df = spark.createDataFrame([*points, (None, 1.0)], "lat double, lon double")
    found = {tuple(r) for r in within_disc(df, lat, lon, radius).collect()}
    assert found == {p for p in points if miles(lat, lon, *p) <= radius}


def test_box_includes_its_sides(spark):
    df = spark.createDataFrame([(44.0, 16.0), (38.0, 8.0), (44.1, 12.0), (40.0, 16.1), (None, 12.0)], "lat double, lon double")
    assert within_box(df, 41.0, 12.0, 3.0, 4.0).count() == 2


def test_shape_follows_the_feed(spark):
    # In the corner of the box, out of the disc.
    df = spark.createDataFrame([(44.8, 16.4)], "lat double, lon double")
    area = Area(radius_nm=200.0)
    assert within_area(df, "opensky", area).count() == 1
    assert within_area(df, "adsbfi", area).count() == 0
