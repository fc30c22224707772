"""Boundary rows for every classification rule: below, at and above each threshold, and NULL."""

import pytest
from pyspark.sql import functions as F

from soarcast.functions import (
    alert_level,
    cloud_alert,
    conditions_vs_avg,
    danger_flag,
    flying_category,
    flying_score,
    season,
    sky_bucket,
    thermal_strength,
    time_of_day,
    wind_alert,
    xc_flag,
)

OBS_COLS = "wind_speed double, cape double, cloud_base_m double, tcc double"


def _labels(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema).withColumn("_i", F.monotonically_increasing_id())
    return [r[0] for r in df.orderBy("_i").select(expr).collect()]


def test_flying_category_boundaries(spark):
    rows = [
        (2.0, 300.01, 800.01, 0.79),  # expert lower edges (inclusive wind, strict others)
        (12.0, 5000.0, 2000.0, 0.0),  # expert wind upper edge
        (12.01, 5000.0, 2000.0, 0.0),  # too windy for anyone
        (2.0, 300.0, 800.01, 0.59),  # cape exactly 300 is not expert -> beginner
        (1.0, 100.0, 500.01, 0.59),  # beginner lower edges
        (8.0, 800.0, 500.01, 0.59),  # beginner upper edges
        (8.0, 800.0, 500.0, 0.59),  # base exactly 500 -> not beginner; student needs wind <= 5
        (1.0, 50.0, 300.01, 0.49),  # student lower edges
        (5.0, 300.0, 300.01, 0.49),  # student wind upper edge, cape 300 not expert (strict)
        (5.0, 300.0, 300.0, 0.49),  # base exactly 300 -> not flyable
        (0.99, 200.0, 1000.0, 0.1),  # too calm
        (None, 200.0, 1000.0, 0.1),  # NULL falls through
        (3.0, None, 1000.0, 0.1),
    ]
    got = _labels(spark, rows, OBS_COLS, flying_category())
    assert got == ["expert", "expert", "not_flyable", "beginner", "beginner", "beginner", "not_flyable",
                   "student", "student", "not_flyable", "not_flyable", "not_flyable", "not_flyable"]


def test_flying_category_strict_nulls(spark):
    got = _labels(spark, [(None, 200.0, 1000.0, 0.1), (3.0, 400.0, 1000.0, 0.1)], OBS_COLS,
                  flying_category(strict_nulls=True))
    assert got == [None, "expert"]


def test_thermal_strength(spark):
    rows = [(99.99,), (100.0,), (499.99,), (500.0,), (999.99,), (1000.0,), (None,)]
    got = _labels(spark, rows, "cape double", thermal_strength("cape"))
    assert got == ["none", "weak", "weak", "moderate", "moderate", "strong", "strong"]


def test_time_of_day(spark):
    rows = [(h,) for h in (5, 6, 9, 10, 13, 14, 17, 18, 20, 21, 23)] + [(None,)]
    got = _labels(spark, rows, "hour int", time_of_day("hour"))
    assert got == ["non_flying", "morning", "morning", "midday", "midday", "afternoon", "afternoon", "evening",
                   "evening", "non_flying", "non_flying", "non_flying"]


def test_season(spark):
    rows = [(m,) for m in range(1, 13)] + [(None,)]
    got = _labels(spark, rows, "month int", season("month"))
    assert got == ["winter", "winter", "spring", "spring", "spring", "summer", "summer", "summer", "autumn",
                   "autumn", "autumn", "winter", "autumn"]


def test_danger_flag(spark):
    rows = [
        (12.0, 2000.0, 100.0, 0.9),  # every value at its threshold: safe
        (12.01, 0.0, 500.0, 0.0),
        (0.0, 2000.01, 500.0, 0.0),
        (0.0, 0.0, 99.99, 0.0),
        (0.0, 0.0, 500.0, 0.91),
        (None, None, None, None),
        (None, 3000.0, None, None),
    ]
    assert _labels(spark, rows, OBS_COLS, danger_flag()) == [0, 1, 1, 1, 1, 0, 1]


def test_xc_flag(spark):
    schema = "cape double, blh double, wind_speed double, cloud_base_m double, tcc double, hour int"
    good = (500.01, 1000.01, 2.0, 1000.01, 0.69, 10)
    rows = [
        good,
        (500.01, 1000.01, 10.0, 1000.01, 0.69, 16),
        (500.0, 1000.01, 2.0, 1000.01, 0.69, 10),
        (500.01, 1000.0, 2.0, 1000.01, 0.69, 10),
        (500.01, 1000.01, 10.01, 1000.01, 0.69, 10),
        (500.01, 1000.01, 2.0, 1000.0, 0.69, 10),
        (500.01, 1000.01, 2.0, 1000.01, 0.7, 10),
        (500.01, 1000.01, 2.0, 1000.01, 0.69, 17),
        (500.01, 1000.01, None, 1000.01, 0.69, 10),
    ]
    assert _labels(spark, rows, schema, xc_flag()) == [1, 1, 0, 0, 0, 0, 0, 0, 0]


def test_sky_bucket(spark):
    rows = [(0.19,), (0.2,), (0.49,), (0.5,), (0.79,), (0.8,), (None,)]
    got = _labels(spark, rows, "t double", sky_bucket("t"))
    assert got == ["clear", "partly_cloudy", "partly_cloudy", "mostly_cloudy", "mostly_cloudy", "overcast",
                   "overcast"]


def test_flying_score(spark):
    schema = "wind_speed double, cloud_base_m double, cloud_cover double"
    rows = [
        (12.01, 3000.0, 0.0),  # too windy
        (12.0, 299.99, 0.0),  # base too low
        (12.0, 300.0, 0.5),  # 2 + (-2 * 0.5) + 0 = 1
        (4.0, 600.0, 0.49),  # 4 + 3 + 2 = 9
        (0.0, 3000.0, 0.0),  # capped at 10
        (None, 600.0, 0.0),  # NULL wind: capped blend ignores NULL -> 10
        (4.0, None, 0.0),
    ]
    got = _labels(spark, rows, schema, flying_score())
    assert got == [0.0, 0.0, 1.0, 9.0, 10.0, 10.0, 10.0]


def test_point_alert(spark):
    schema = "wind_speed double, wind_gust double, cloud_base_m double"
    rows = [
        (12.01, 0.0, 1000.0),
        (12.0, 15.01, 1000.0),
        (12.0, 15.0, 199.99),
        (8.01, 15.0, 499.99),
        (8.0, 15.0, 499.99),
        (8.01, 15.0, 500.0),
        (None, None, None),
    ]
    got = _labels(spark, rows, schema, alert_level())
    assert got == ["DANGER_HIGH_WIND", "DANGER_GUSTS", "DANGER_LOW_CLOUD", "WARNING_COMBINED", "SAFE", "SAFE",
                   "SAFE"]


def test_window_alerts(spark):
    rows = [(10.01, 299.99), (10.0, 300.0), (7.01, 599.99), (7.0, 600.0), (None, None)]
    schema = "max_wind double, min_cloud_base double"
    assert _labels(spark, rows, schema, wind_alert("max_wind")) == [
        "HIGH_WIND", "MODERATE_WIND", "MODERATE_WIND", "OK", "OK"]
    assert _labels(spark, rows, schema, cloud_alert("min_cloud_base")) == [
        "LOW_CLOUD", "MODERATE_CLOUD", "MODERATE_CLOUD", "OK", "OK"]


@pytest.mark.parametrize("diff,label", [(3.01, "WORSE_THAN_AVG"), (3.0, "AVERAGE"), (-3.0, "AVERAGE"),
                                        (-3.01, "BETTER_THAN_AVG"), (None, "AVERAGE")])
def test_conditions_vs_avg(spark, diff, label):
    assert _labels(spark, [(diff,)], "d double", conditions_vs_avg("d")) == [label]
