"""Zones, marts, cube flattening and the batch pipeline."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from soarcast.functions import add_cell_id, transform
from soarcast.functions.derive import wind_speed, with_calendar
from soarcast.plans import MARTS, refresh_zone, run_batch
from soarcast.plans import marts as M
from soarcast.sources import (
    fixtures,
    flatten_cube,
    read_mart,
    read_raw,
    read_transformed,
    replace_year,
    replace_zone_year,
    write_transformed,
)
from soarcast.session import session_settings, utc_session


def _raw_zone(spark, path):
    raw = fixtures.grid_raw(spark, SF_SMALL).drop("obs_id")
    raw.withColumn("year", F.year("time")).write.partitionBy("year").parquet(path)


def _canon(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


def test_transformed_zone_round_trip(spark, scratch):
    obs = transform(fixtures.grid_raw(spark, SF_SMALL).drop("obs_id"))
    write_transformed(obs, f"{scratch}/zone")
    back = read_transformed(spark, f"{scratch}/zone")
    assert sorted(back.columns) == sorted([*obs.columns, "cell_id"])
    assert _canon(back) == _canon(add_cell_id(obs).select(back.columns))
    (version,) = [d for d in os.listdir(f"{scratch}/zone") if d.startswith("version=")]
    years = sorted(d for d in os.listdir(f"{scratch}/zone/{version}") if d.startswith("year="))
    assert years == [f"year={y}" for y in range(1995, 2002)]
    assert sorted(os.listdir(f"{scratch}/zone/{version}/year=1996"))[:2] == ["month=1", "month=10"]


def test_year_replace_drops_vanished_months_and_keeps_other_years(spark, scratch):
    obs = transform(fixtures.grid_raw(spark, SF_SMALL).drop("obs_id"))
    write_transformed(obs, f"{scratch}/zone")
    before = read_transformed(spark, f"{scratch}/zone").groupBy("year").count().collect()
    replace_zone_year(obs.filter("year = 1997 AND month = 3").limit(1), f"{scratch}/zone", 1997)
    after = {r.year: r["count"] for r in read_transformed(spark, f"{scratch}/zone").groupBy("year").count().collect()}
    left = read_transformed(spark, f"{scratch}/zone").filter("year = 1997").groupBy("month").count().collect()
    assert [(r.month, r["count"]) for r in left] == [(3, 1)]
    for r in before:
        if r.year != 1997:
            assert after[r.year] == r["count"]


def test_a_year_is_refreshed_from_its_neighbour_folders(spark, scratch):
    """A stray row of Y in folder Y+1 neither gets lost nor replaces the rest of its month."""
    hours = spark.sql("""
        SELECT t AS time, 45.0D AS latitude, 20.0D AS longitude, 280D AS t2m, 275D AS d2m, 1F AS u10, 2F AS v10,
               100D AS cape, 500D AS blh, 95000D AS sp, 0.5D AS tcc
        FROM (SELECT explode(sequence(timestamp'2019-12-01 00:00:00', timestamp'2019-12-31 23:00:00', interval 1 hour)) AS t)""")
    last = hours.filter("time = timestamp'2019-12-31 23:00:00'")
    hours.subtract(last).withColumn("year", F.lit(2019)).write.partitionBy("year").parquet(f"{scratch}/raw")
    last.withColumn("year", F.lit(2020)).write.mode("append").partitionBy("year").parquet(f"{scratch}/raw")
    refresh_zone(spark, f"{scratch}/raw", f"{scratch}/zone")
    for year in (2020, 2019):
        refresh_zone(spark, f"{scratch}/raw", f"{scratch}/zone", years=[year])
        zone = read_transformed(spark, f"{scratch}/zone")
        assert zone.filter("year = 2019 AND month = 12").count() == 744 and zone.count() == 744


def test_files_hold_whole_cells(spark, scratch):
    """Time-ordered input: a file of a month holds few cells with all their hours."""
    cells = spark.range(64).select((F.col("id") % 8 * 3.0 + 30).alias("latitude"), (F.floor(F.col("id") / 8) * 3.0).alias("longitude"))
    hours = spark.sql("SELECT explode(sequence(timestamp'2020-06-01 00:00:00', timestamp'2020-06-30 23:00:00', interval 1 hour)) AS time")
    grid = hours.repartitionByRange(8, "time").join(F.broadcast(cells))
    raw = grid.selectExpr("*", "280D t2m", "275D d2m", "1D u10", "2D v10", "100D cape", "500D blh", "95000D sp", "0.5D tcc")
    with session_settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}):
        write_transformed(transform(raw), f"{scratch}/zone")
    zone = spark.read.parquet(f"{scratch}/zone").withColumn("file", F.input_file_name())
    per_file = zone.groupBy("file", "latitude", "longitude").count()
    assert per_file.filter("count = 720").count() >= 0.7 * 64  # a tile split by size cuts some cells
    assert per_file.select("file").distinct().count() <= 64


def test_single_precision_grids_are_derived_in_double(spark, scratch):
    df = spark.createDataFrame([(12.0, 0.0011)], "u10 double, v10 double").selectExpr("float(u10)", "float(v10)")
    got = df.select(wind_speed()).first()[0]
    assert got > 12 and round(got, 8) == 12.00000005


def test_a_session_in_another_zone_gives_utc_or_an_error(spark, scratch):
    df = spark.createDataFrame([(1577836800000000000,)], "time bigint")  # 2020-01-01 00:00 UTC
    with session_settings(spark, {"spark.sql.session.timeZone": "America/New_York"}):
        with pytest.raises(ValueError, match="UTC"):
            with_calendar(df)
        with utc_session(spark):
            row = with_calendar(df).select("year", "month", "hour").first()
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    assert tuple(row) == (2020, 1, 0)


def test_read_raw_prunes_years(spark, scratch):
    _raw_zone(spark, f"{scratch}/raw")
    df = read_raw(spark, f"{scratch}/raw", years=[1998])
    assert "PartitionFilters: [isnotnull(year" in df._jdf.queryExecution().executedPlan().toString()
    assert {r.y for r in df.select(F.year("time").alias("y")).distinct().collect()} == {1998}


def test_replace_year_leaves_other_years(spark, scratch):
    _raw_zone(spark, f"{scratch}/raw")
    counts = {r.year: r["count"] for r in spark.read.parquet(f"{scratch}/raw").groupBy("year").count().collect()}
    one = read_raw(spark, f"{scratch}/raw", years=[1999]).limit(3)
    staged = f"{scratch}/staged"
    one.write.parquet(staged)  # the new rows must not be read from the folder being replaced
    replace_year(spark.read.parquet(staged), f"{scratch}/raw", 1999)
    after = {r.year: r["count"] for r in spark.read.parquet(f"{scratch}/raw").groupBy("year").count().collect()}
    assert after[1999] == 3
    assert {k: v for k, v in after.items() if k != 1999} == {k: v for k, v in counts.items() if k != 1999}


def test_flatten_cube(spark):
    times = [dt.datetime(2020, 7, 1, 10), dt.datetime(2020, 7, 1, 11)]
    lats, lons = [45.0, 44.75], [20.0, 20.25, 20.5]
    t2m = [[[280.0 + t * 10 + a + o / 10 for o in range(3)] for a in range(2)] for t in range(2)]
    cape = [[[float(t * 100 + a * 10 + o) for o in range(3)] for a in range(2)] for t in range(2)]
    cube = spark.createDataFrame(
        [(times, lats, lons, t2m, cape, 0)],
        "time array<timestamp>, latitude array<double>, longitude array<double>, "
        "t2m array<array<array<double>>>, cape array<array<array<double>>>, number int",
    )
    flat = flatten_cube(cube, ["time", "latitude", "longitude"], ["t2m", "cape"])
    rows = flat.collect()
    assert len(rows) == 12 and set(flat.columns) == {"time", "latitude", "longitude", "t2m", "cape"}
    by_key = {(r.time, r.latitude, r.longitude): r.cape for r in rows}
    assert by_key[(times[1], 44.75, 20.5)] == 112.0
    with_aux = flatten_cube(cube, ["time", "latitude", "longitude"], ["t2m", "cape"], keys=["number"])
    assert "number" not in with_aux.columns  # auxiliary ingest columns are dropped


def test_run_batch_writes_every_mart(spark, scratch):
    _raw_zone(spark, f"{scratch}/raw")
    written = run_batch(spark, f"{scratch}/raw", f"{scratch}/zone", f"{scratch}/marts")
    assert set(written) == set(MARTS)
    obs = transform(fixtures.grid_raw(spark, SF_SMALL).drop("obs_id"))
    for name in ("q1_flying_hours_by_month", "q3_hourly_conditions", "q8_afternoon_prediction"):
        assert _canon(read_mart(spark, f"{scratch}/marts", name)) == _canon(MARTS[name](obs))
    # incremental: re-process one raw year; marts still cover all years
    run_batch(spark, f"{scratch}/raw", f"{scratch}/zone", f"{scratch}/marts", years=[2000],
              marts=["q10_climate_trend"])
    q10 = read_mart(spark, f"{scratch}/marts", "q10_climate_trend")
    assert _canon(q10) == _canon(M.climate_trend(obs))


def test_years_of_one_zone_may_differ_in_types(spark, scratch):
    """INT96, INT64 and nanosecond timestamps, epoch nanoseconds, float and double: equal rows whatever footer comes first."""
    times = [dt.datetime(2019, 5, 1, h, 30, 0, 123456) for h in range(3)]
    kinds = [(pa.float32(), pa.timestamp("us", "UTC"), {}), (pa.float64(), pa.timestamp("ns", "UTC"), {}), (pa.float64(), pa.timestamp("ns"), {"use_deprecated_int96_timestamps": True}),
             (pa.float32(), pa.int64(), {}), (pa.int32(), pa.timestamp("us", "UTC"), {})]
    for order in (kinds, kinds[::-1]):
        root = f"{scratch}/raw{kinds.index(order[0])}"
        for i, (number, time, options) in enumerate(order):
            at = [t.replace(year=2015 + i // 2) for t in times]  # two kinds in one folder
            epoch = [int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000) * 1000 for t in at]
            table = pa.table({"time": pa.array(epoch if time == pa.int64() else at, time), "latitude": pa.array([45] * 3, number), "longitude": pa.array([20, 21, 22], number),
                              "t2m": pa.array([280] * 3, number), **({"number": pa.array([0] * 3)} if i else {})})
            folder = f"{root}/year={2015 + i // 2}"
            os.makedirs(folder, exist_ok=True)
            pq.write_table(table, f"{folder}/{i}.parquet", **options)
        df = read_raw(spark, root)
        assert dict(df.dtypes) == {"time": "timestamp", "latitude": "double", "longitude": "double", "t2m": "double", "year": "int"}
        got = sorted((r.time, r.latitude, r.longitude, r.t2m) for r in df.collect())
        want = sorted((t.replace(year=2015 + i // 2), 45.0, 20.0 + k, 280.0) for i in range(5) for k, t in enumerate(times))
        assert got == want
        one = read_raw(spark, root, years=[2016])
        assert one.count() == 6 and all("year=2016" in f for f in one.inputFiles())


def test_nanosecond_zones_in_a_session_without_the_defaults(spark, scratch):
    os.makedirs(f"{scratch}/raw/year=2020")
    time = pa.array([dt.datetime(2020, 6, 1, 10)], pa.timestamp("ns", "UTC"))
    row = {"latitude": 45.0, "longitude": 20.0, "t2m": 280.0, "d2m": 275.0, "u10": 1.0, "v10": 2.0, "cape": 100.0, "blh": 500.0, "sp": 95000.0, "tcc": 0.5}
    pq.write_table(pa.table({"time": time, **{k: [v] for k, v in row.items()}}), f"{scratch}/raw/year=2020/a.parquet")
    with session_settings(spark, {"spark.sql.legacy.parquet.nanosAsLong": "false"}):
        refresh_zone(spark, f"{scratch}/raw", f"{scratch}/zone")
        assert read_transformed(spark, f"{scratch}/zone").first().hour == 10
