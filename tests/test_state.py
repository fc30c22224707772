"""Marts from state by year: equal to a rebuild, and made from changed years only."""

import glob
import statistics

import pytest
from pyspark.sql import functions as F
from test_random_grids import SCHEMA, _random_raw

from soarcast.functions import transform
from soarcast.functions.moments import corr_of, mean_of, merged, merged_pairs, moments, pair_moments, stddev_of
from soarcast.plans import MARTS, build_marts, run_batch
from soarcast.plans.state import STATE, state_table
from soarcast.sources import Published, observations, read_mart, read_transformed, replace_year


def _rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def _raw(spark, path, seed):
    raw = spark.createDataFrame(_random_raw(seed, 1500, 0.01), SCHEMA).drop("obs_id")
    raw.withColumn("year", F.coalesce(F.year("time"), F.lit(2019))).write.partitionBy("year").parquet(path)


def _marts_equal(spark, root, other, names=MARTS):
    for name in names:
        assert _rows(read_mart(spark, root, name)) == _rows(read_mart(spark, other, name)), name


def test_moments_merge_without_cancellation(spark):
    xs = [1e6 + k * 0.001 for k in range(40)]
    rows = [(k % 4, x, -3 * x + k % 2) for k, x in enumerate(xs)] + [(5, None, 1.0), (6, 7e8, None)]
    df = spark.createDataFrame(rows, "year int, x double, y double")
    state = df.groupBy("year").agg(moments("x").alias("x"), pair_moments("x", "y").alias("xy"))
    got = state.filter("year < 6").agg(
        mean_of(merged("x", "year")).alias("mean"), stddev_of(merged("x", "year")).alias("sd"), corr_of(merged_pairs("xy", "year")).alias("r")).first()
    assert abs(got["mean"] - statistics.fmean(xs)) < 1e-6
    assert abs(got["sd"] - statistics.stdev(xs)) < 1e-9
    assert abs(got["r"] - statistics.correlation(xs, [-3 * x + k % 2 for k, x in enumerate(xs)])) < 1e-6
    few = state.agg(merged("x", "year").alias("m")).filter("false")
    assert few.count() == 0
    one = state.filter("year = 6").agg(stddev_of(merged("x", "year")).alias("sd"), corr_of(merged_pairs("xy", "year")).alias("r"), mean_of(merged("x", "year")).alias("m")).first()
    assert tuple(one) == (None, None, 7e8)
    none = state.filter("year = 5").agg(mean_of(merged("x", "year")).alias("m")).first()
    assert none.m is None


@pytest.fixture(scope="module")
def refreshed(spark, tmp_path_factory):
    """A batch, and one raw year replaced after it."""
    d = str(tmp_path_factory.mktemp("state"))
    _raw(spark, f"{d}/raw", 11)
    run_batch(spark, f"{d}/raw", f"{d}/zone", f"{d}/marts")
    fresh = spark.createDataFrame(_random_raw(12, 500), SCHEMA).drop("obs_id").filter("year(time) = 2020")
    replace_year(fresh, f"{d}/raw", 2020)
    return d


def test_state_of_changed_years_equals_a_rebuild(spark, refreshed):
    d = refreshed
    before = {n: state_table(spark, f"{d}/marts", n).parts for n in STATE if n != "grid_sketches"}
    run_batch(spark, f"{d}/raw", f"{d}/zone", f"{d}/marts", years=[2020])
    for name, parts in before.items():
        now = state_table(spark, f"{d}/marts", name).parts
        assert {y for y in parts if parts[y] != now.get(y)} == {"2020"}, name
    run_batch(spark, f"{d}/raw", f"{d}/zone_full", f"{d}/marts_full")
    _marts_equal(spark, f"{d}/marts", f"{d}/marts_full")

    # a run for one mart leaves the others' state behind; the next run catches up on both years
    some = ["q2_location_stability", "q10_climate_trend"]
    replace_year(spark.createDataFrame(_random_raw(13, 400), SCHEMA).drop("obs_id").filter("year(time) = 2021"), f"{d}/raw", 2021)
    run_batch(spark, f"{d}/raw", f"{d}/zone", f"{d}/marts", years=[2021], marts=some[1:])
    replace_year(spark.createDataFrame(_random_raw(14, 400), SCHEMA).drop("obs_id").filter("year(time) = 2020"), f"{d}/raw", 2020)
    run_batch(spark, f"{d}/raw", f"{d}/zone", f"{d}/marts", years=[2020], marts=some)
    run_batch(spark, f"{d}/raw", f"{d}/zone_full2", f"{d}/marts_full2", marts=some)
    _marts_equal(spark, f"{d}/marts", f"{d}/marts_full2", some)


def test_years_that_did_not_change_are_not_read(spark, tmp_path):
    d = str(tmp_path)
    _raw(spark, f"{d}/raw", 21)
    run_batch(spark, f"{d}/raw", f"{d}/zone", f"{d}/marts", marts=["q2_location_stability", "q10_climate_trend"])
    want = _rows(read_mart(spark, f"{d}/marts", "q10_climate_trend").filter("year = 2019"))
    zone = Published(spark, f"{d}/zone")
    assert {"2019", "2020", "2021"} <= set(zone.parts)
    for year in ("2019", "2021"):
        for file in glob.glob(f"{zone.folder(year)}/month=*/*.parquet"):
            with open(file, "wb") as out:
                out.write(b"not a Parquet file")
    run_batch(spark, f"{d}/raw", f"{d}/zone", f"{d}/marts", years=[2020], marts=["q2_location_stability", "q10_climate_trend"])
    assert _rows(read_mart(spark, f"{d}/marts", "q10_climate_trend").filter("year = 2019")) == want
    with pytest.raises(Exception):
        read_transformed(spark, f"{d}/zone").agg(F.sum("cape")).collect()


def test_a_year_that_goes_leaves_the_marts(spark, tmp_path):
    d = str(tmp_path)
    names = ["q1_flying_hours_by_month", "q8_afternoon_prediction", "q10_climate_trend"]
    _raw(spark, f"{d}/raw", 31)
    run_batch(spark, f"{d}/raw", f"{d}/zone", f"{d}/marts", marts=names)
    zone = Published(spark, f"{d}/zone")
    zone.replace_years({"2019": None})
    build_marts(spark, observations(zone), f"{d}/marts", names, source=zone.parts)
    build_marts(spark, observations(zone), f"{d}/again", names)
    _marts_equal(spark, f"{d}/marts", f"{d}/again", names)
    assert 2019 not in {r.year for r in read_mart(spark, f"{d}/marts", "q10_climate_trend").collect()}


def test_grid_counts_from_sketches(spark, tmp_path):
    raw = spark.createDataFrame(_random_raw(41, 900), SCHEMA)
    obs = transform(raw)
    build_marts(spark, obs, f"{tmp_path}/exact", ["q1_flying_hours_by_month", "q7_xc_best_months"])
    build_marts(spark, obs, f"{tmp_path}/sketch", ["q1_flying_hours_by_month", "q7_xc_best_months"], approximate=True)
    for name in ("q1_flying_hours_by_month", "q7_xc_best_months"):  # few cells: the estimate is exact
        assert _rows(read_mart(spark, f"{tmp_path}/exact", name)) == _rows(read_mart(spark, f"{tmp_path}/sketch", name))
    assert not state_table(spark, f"{tmp_path}/sketch", "grid_cells").exists
