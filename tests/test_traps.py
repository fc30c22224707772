"""One test per semantic trap."""

import datetime as dt
import os

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Row
from pyspark.sql import functions as F

from soarcast.functions import normalize_time, safe_corr, stable_round, transform, wind_direction
from soarcast.operators import distinct_count, global_rank
from soarcast.plans import marts
from soarcast.sources import read_raw
from soarcast.sources.events import parse_events, split_valid


def _raw_rows(n_hours=3):
    base = pd.Timestamp("2020-07-01 10:00:00")
    return pd.DataFrame({
        "time": [base + pd.Timedelta(hours=i) for i in range(n_hours)],
        "latitude": [45.0] * n_hours, "longitude": [20.0] * n_hours,
        "t2m": [300.0] * n_hours, "cape": [600.0] * n_hours, "blh": [1500.0] * n_hours,
        "u10": [3.0] * n_hours, "v10": [4.0] * n_hours, "d2m": [290.0] * n_hours,
        "sp": [95000.0] * n_hours, "tcc": [0.1] * n_hours,
        "number": [0] * n_hours, "expver": ["1"] * n_hours,
    })


def test_t1_nanosecond_parquet_time(spark, scratch):
    """Decoded grids land with TIMESTAMP(NANOS); they are read as epoch-ns and normalised."""
    pdf = _raw_rows()
    folder = os.path.join(scratch, "raw", "year=2020")
    os.makedirs(folder)
    table = pa.Table.from_pandas(pdf, preserve_index=False)
    pq.write_table(table, os.path.join(folder, "part.parquet"), version="2.6", coerce_timestamps=None)
    raw = read_raw(spark, os.path.join(scratch, "raw"))
    assert "number" not in raw.columns and "expver" not in raw.columns
    assert dict(raw.dtypes)["time"] == "bigint"
    obs = transform(raw).orderBy("time").collect()
    assert [(r.year, r.month, r.day, r.hour) for r in obs] == [(2020, 7, 1, 10), (2020, 7, 1, 11), (2020, 7, 1, 12)]
    assert obs[0].time == dt.datetime(2020, 7, 1, 10, 0)


def test_t1_time_types(spark):
    df = spark.createDataFrame(
        [(1_593_597_600_000_000_123, 1_593_597_600.5, "2020-07-01T10:00:00", "bad")],
        "ns long, secs double, iso string, junk string",
    )
    out = normalize_time(normalize_time(normalize_time(normalize_time(df, "ns"), "secs"), "iso"), "junk").first()
    assert out.ns == dt.datetime(2020, 7, 1, 10, 0)
    assert out.secs == dt.datetime(2020, 7, 1, 10, 0, 0, 500000)
    assert out.iso == dt.datetime(2020, 7, 1, 10, 0)
    assert out.junk is None


def test_t2_session_zone_is_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_t3_null_inputs_fall_through(spark):
    raw = spark.createDataFrame(
        [Row(time=dt.datetime(2020, 7, 1, 10), latitude=45.0, longitude=20.0, t2m=300.0, d2m=290.0, u10=3.0,
             v10=4.0, cape=None, blh=1500.0, sp=95000.0, tcc=0.1)],
        "time timestamp, latitude double, longitude double, t2m double, d2m double, u10 double, v10 double, "
        "cape double, blh double, sp double, tcc double",
    )
    row = transform(raw).first()
    assert row.thermal_strength == "strong" and row.flying_category == "not_flyable"
    strict = transform(raw, strict_nulls=True).first()
    assert strict.thermal_strength is None and strict.flying_category is None


def test_t5_afternoon_category_is_lexicographic_max(spark):
    df = spark.createDataFrame([("beginner",), ("not_flyable",), ("expert",)], "c string")
    assert df.agg(F.max("c")).first()[0] == "not_flyable"
    df2 = df.union(spark.createDataFrame([("student",)], "c string"))
    assert df2.agg(F.max("c")).first()[0] == "student"


def test_t6_ratio_by_zero_is_null(spark):
    from soarcast.functions import ratio

    assert spark.range(1).select(ratio(F.lit(5), F.lit(0))).first()[0] is None


def test_t7_constant_column_corr_is_null(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (1, 1.0, 3.0), (2, 1.0, 1.0), (2, 2.0, 2.0), (2, 3.0, 3.5),
                                (3, 5.0, None), (3, 6.0, 1.0)], "k int, a double, b double")
    got = {r.k: r.c for r in df.groupBy("k").agg(safe_corr("a", "b").alias("c")).collect()}
    assert got[1] is None  # constant a
    assert abs(got[2] - 0.9933992677987828) < 1e-12  # Pearson r of (1,2),(2,2),(3,3.5)
    assert got[3] is None  # one complete pair only


def test_t8_single_hour_cell_ranks_last(spark):
    cells = spark.createDataFrame([(1.0, 0.5), (2.0, None), (3.0, 0.2)], "latitude double, stability_score double")
    ranked = {r.latitude: r.rank for r in global_rank(cells, "stability_score").collect()}
    assert ranked == {3.0: 1, 1.0: 2, 2.0: 3}


def test_t9_distinct_count_keeps_null_keys(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (None, None), (1.0, 2.0)], "latitude double, longitude double")
    n = spark.range(1).select(distinct_count(df, "latitude", "longitude")).first()[0]
    assert n == df.select("latitude", "longitude").distinct().count() == 3


def test_t10_t11_malformed_events_go_to_dead_letter(spark):
    msgs = spark.createDataFrame(
        [('{"timestamp": "2024-01-01T00:00:07.5", "location": "Vrsac", "wind_speed": 3.0}',),
         ("{not json",),
         ('{"timestamp": "yesterday", "location": "Vrsac"}',),
         ('{"timestamp": "2024-01-01T00:10:00", "wind_speed": 3.0}',)],
        "value string",
    )
    events = parse_events(msgs)
    valid, rejected = split_valid(events)
    assert valid.count() == 1 and rejected.count() == 3
    assert valid.first().event_time == dt.datetime(2024, 1, 1, 0, 0, 7, 500000)


def test_t12_rounding_is_half_up_on_the_decimal_value(spark):
    # 1.0049999999999 is summation noise around the half (within 5e-10): it rounds as the half;
    # 1.00499999 is a real value below the half
    df = spark.createDataFrame(
        [(1.005,), (0.285,), (-0.285,), (2.675,), (1.0049999999999,), (1.00499999,), (2e19,), (-3e25,), (float("inf"),), (None,),
         (float("nan"),)], "x double")
    got = [r[0] for r in df.select(stable_round("x", 2)).collect()]
    assert got[:-1] == [1.01, 0.29, -0.29, 2.68, 1.01, 1.0, 2e19, -3e25, float("inf"), None]
    assert got[-1] != got[-1]  # NaN stays NaN


def test_t13_percent_rank_uses_rounded_values(spark):
    df = spark.createDataFrame([(1, 0.3333333), (2, 0.33333333333)], "m int, v double")
    rounded = df.select("m", stable_round("v", 1).alias("r"))
    from soarcast.operators import small_rank

    assert {r.m: r.rank for r in small_rank(rounded, "r").collect()} == {1: 1, 2: 1}


def test_t16_calm_wind_points_180(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, -1.0), (-1.0, 0.0), (1.0, 0.0)], "u double, v double")
    got = [round(r[0], 9) for r in df.select(wind_direction("u", "v")).collect()]
    assert got == [180.0, 0.0, 90.0, 270.0]


def test_t15_baseline_is_by_hour_only(spark):
    obs = spark.createDataFrame([(5, 2.0, 100.0), (5, 4.0, 300.0)], "hour int, wind_speed double, cloud_base_m double")
    # two grid rows in the same hour, one mart row for that hour
    mart = obs.groupBy("hour").agg(F.avg("wind_speed").alias("avg_wind"),
                                   F.avg("cloud_base_m").alias("avg_cloud_base"))
    from soarcast.operators import hourly_baseline

    base = hourly_baseline(mart).collect()
    assert [(r.hist_hour, r.hist_wind, r.hist_cloud_base) for r in base] == [(5, 3.0, 200.0)]


def test_q2_all_one_row_cells(spark):
    """Every cell with one hour: all scores NULL, all share the last rank."""
    raw = spark.createDataFrame(
        [Row(time=dt.datetime(2020, 7, 1, 10), latitude=45.0 + i, longitude=20.0, t2m=300.0, d2m=290.0,
             u10=3.0, v10=4.0, cape=600.0, blh=1500.0, sp=95000.0, tcc=0.1) for i in range(3)],
        "time timestamp, latitude double, longitude double, t2m double, d2m double, u10 double, v10 double, "
        "cape double, blh double, sp double, tcc double",
    )
    rows = marts.cell_stability(transform(raw)).collect()
    assert {r.stability_rank for r in rows} == {1} and all(r.stability_score is None for r in rows)


def test_s4_event_hour_missing_from_baseline(spark):
    from soarcast.operators import hourly_baseline
    from soarcast.streaming import versus_baseline

    mart = spark.createDataFrame([(10, 5.0, 800.0)], "hour int, avg_wind double, avg_cloud_base double")
    events = spark.createDataFrame(
        [("2024-01-01T10:15:00", "Vrsac", 45.1, 21.3, 9.5, 700.0, 12.0, dt.datetime(2024, 1, 1, 10, 15)),
         ("2024-01-01T11:15:00", "Vrsac", 45.1, 21.3, 9.5, 700.0, 12.0, dt.datetime(2024, 1, 1, 11, 15))],
        "timestamp string, location string, lat double, lon double, wind_speed double, cloud_base_m double, "
        "temp_c double, event_time timestamp",
    )
    rows = {r.hour: r for r in versus_baseline(events, hourly_baseline(mart)).collect()}
    assert (rows[10].wind_vs_historical, rows[10].cloud_base_vs_historical, rows[10].conditions_vs_avg) == (
        4.5, -100.0, "WORSE_THAN_AVG")
    assert rows[11].hist_wind is None and rows[11].conditions_vs_avg == "AVERAGE"


def test_int_seconds_time(spark):
    df = spark.createDataFrame([(1_593_597_600,)], "t int")
    assert normalize_time(df, "t").first().t == dt.datetime(2020, 7, 1, 10, 0)


def test_date_time_column(spark):
    df = spark.createDataFrame([(dt.date(2020, 7, 1),)], "t date")
    assert normalize_time(df, "t").first().t == dt.datetime(2020, 7, 1, 0, 0)
