from __future__ import annotations

from datetime import datetime, timezone

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skytally.functions import clock, country, geo, text

# Published geodesic lengths on WGS-84, in metres.
KNOWN = [
    ((40.6, -73.8, 51.6, -0.5), 5551759.400),
    ((0.0, 0.0, 0.5, 179.5), 19936288.579),
    ((0.0, 0.0, 0.5, 179.7), 19944127.421),
    ((-41.32, 174.81, 40.96, -5.50), 19959679.267),
    ((90.0, 0.0, -90.0, 50.0), 20003931.4586),
    ((0.0, 0.0, 0.0, 180.0), 20003931.4586),
    ((10.0, 10.0, 10.0, 10.0), 0.0),
]


def test_known_lengths(spark):
    df = spark.createDataFrame([pair for pair, _ in KNOWN], "a double, b double, c double, d double")
    found = [r[0] for r in df.select(geo.geodesic_km("a", "b", "c", "d")).collect()]
    assert found == pytest.approx([m / 1000 for _, m in KNOWN], abs=1e-5)


def test_missing_coordinate_gives_null(spark):
    df = spark.createDataFrame([(1.0, None, 2.0, 3.0)], "a double, b double, c double, d double")
    for method in ("spheroid", "sphere"):
        assert df.select(geo.geodesic_km("a", "b", "c", "d", method)).first()[0] is None


def test_unknown_method():
    with pytest.raises(ValueError):
        geo.geodesic_km("a", "b", "c", "d", "flat")


degrees = st.floats(-90, 90, allow_nan=False)
turns = st.floats(-180, 180, allow_nan=False)


@settings(max_examples=200, deadline=None)
@given(degrees, turns, degrees, turns)
def test_symmetric_and_near_the_sphere(lat1, lon1, lat2, lon2):
    there = geo.inverse_m(*(np.array([v]) for v in (lat1, lon1, lat2, lon2)))[0]
    back = geo.inverse_m(*(np.array([v]) for v in (lat2, lon2, lat1, lon1)))[0]
    assert there == pytest.approx(back, abs=1e-3)
    assert 0 <= there <= 20003931.46
    a, b, c, d = np.radians([lat1, lon1, lat2, lon2])
    half = np.sin((c - a) / 2) ** 2 + np.cos(a) * np.cos(c) * np.sin((d - b) / 2) ** 2
    sphere = 2 * geo.MEAN_RADIUS_KM * 1000 * np.arcsin(np.sqrt(min(half, 1.0)))
    assert there == pytest.approx(sphere, rel=0.006, abs=1e-3)


def test_both_iterations_agree():
    rng = np.random.default_rng(7)
    lat1, lat2 = rng.uniform(-85, 85, (2, 3000))
    lon = rng.uniform(0, 170, 3000)
    beta1, beta2 = (np.arctan((1 - geo.WGS84_F) * np.tan(np.radians(v))) for v in (lat1, lat2))
    slow = geo._antipodal_m(beta1, beta2, np.radians(lon))
    assert np.abs(slow - geo.inverse_m(lat1, np.zeros(3000), lat2, lon)).max() < 1e-3


def test_window_start_rounds(spark):
    one = spark.range(1)
    assert one.select(clock.window_start(1000.6, 600)).first()[0] == 401
    assert one.select(clock.window_start(datetime(1970, 1, 1, 0, 20, tzinfo=timezone.utc), 600)).first()[0] == 600
    stamp = F.timestamp_micros(F.lit(1000_400_000))
    assert one.select(clock.window_start(stamp, 600)).first()[0] == 400


def test_half_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (-2.5,), (2.51,), (None,)], "v double")
    assert [r[0] for r in df.select(clock.half_even_int(F.col("v"))).collect()] == [2, 4, -2, 3, None]


def test_text_functions(spark):
    df = spark.createDataFrame([("Boeing 737 x",), ("",), ("Cessna",), (None,)], "s string")
    assert [r[0] for r in df.select(text.first_word("s")).collect()] == ["Boeing", "", "Cessna", None]
    df = spark.createDataFrame([("ICAO:AFR:x",), ("ICAO:",), ("none",), ("a: b ",)], "s string")
    assert [r[0] for r in df.select(text.field_after("s")).collect()] == ["AFR", "", None, " b "]
    df = spark.createDataFrame([("  a b \t\n ",), ("",)], "s string")
    assert [r[0] for r in df.select(text.strip("s")).collect()] == ["a b", ""]
    df = spark.createDataFrame([([["a", ""], [], ["", "b"]],)], "r array<array<string>>")
    assert df.select(text.non_empty_cells("r")).first()[0] == ["a", "b"]


def test_continent_tables(spark):
    overrides = country.override_continents(spark)
    assert overrides.count() == 54
    assert overrides.filter("country = 'Hong Kong'").first()["continent"] == "Asia"
    names = spark.createDataFrame([("France", "FR"), ("Peru", "PE")], "country string, alpha2 string")
    codes = spark.createDataFrame([("FR", "EU"), ("PE", "SA")], "alpha2 string, continent_code string")
    chained = dict(country.standard_continents(names, codes).collect())
    assert chained == {"France": "Europe", "Peru": "South America"}
