"""Cell ids, boxes and nearest cells."""

import glob
import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from soarcast.functions import add_cell_id, transform
from soarcast.functions.cells import LATTICE, _encode, box_ranges
from soarcast.operators import grid_positions, in_box, nearest_cells, site_baseline
from soarcast.session import stored
from soarcast.sources import fixtures, read_transformed, write_transformed

NAN = float("nan")


def _ids(spark, positions):
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(positions)], "i int, latitude double, longitude double")
    return [r.cell_id for r in add_cell_id(rows).orderBy("i").collect()]


def test_every_position_has_an_id_of_its_own(spark):
    grid = [(a / 4, o / 4) for a in range(-360, 361, 7) for o in range(-720, 1441, 13)]
    odd = [(None, 20.0), (None, 20.25), (20.0, None), (None, None), (NAN, 20.0), (20.0, NAN), (NAN, NAN), (NAN, None), (None, NAN),
           (300.0, 20.0), (-300.0, 20.0), (20.0, 600.0), (20.0, -600.0), (45.1, 20.0), (45.1000005, 20.0), (math.inf, 0.0), (0.0, -math.inf)]
    ids = _ids(spark, grid + odd)
    # what lies beyond the domain on one side has one code: 300 and infinity, at other longitudes
    assert None not in ids and len(set(ids)) == len(ids) and all(0 <= i < 2**62 for i in ids)
    assert ids[0] == _encode(int((grid[0][0] + 256) * LATTICE), int((grid[0][1] + 512) * LATTICE))


def test_equal_positions_share_an_id(spark):
    assert len(set(_ids(spark, [(-0.0, 0.0), (0.0, -0.0), (0.0, 0.0), (1e-8, -1e-8)]))) == 1
    assert len(set(_ids(spark, [(300.0, 1.0), (999.0, 1.0)]))) == 1  # beyond the domain: one code
    single = spark.sql("SELECT float(45.25) latitude, float(20.5) longitude")
    assert add_cell_id(single).first().cell_id == _ids(spark, [(45.25, 20.5)])[0]


def test_box_ranges_cover_the_box_and_little_else():
    rng = random.Random(3)
    for _ in range(40):
        s, w = rng.uniform(-90, 80), rng.uniform(-180, 170)
        n, e = s + rng.uniform(0, 15), w + rng.uniform(0, 15)
        ranges = box_ranges(s, w, n, e)
        assert len(ranges) <= 32 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
        inside = lambda la, lo: any(a <= _encode(int((la + 256) * LATTICE + 0.5), int((lo + 512) * LATTICE + 0.5)) <= b for a, b in ranges)  # noqa: B023, E731
        assert all(inside(rng.uniform(s, n), rng.uniform(w, e)) for _ in range(100))
    small = sum(b - a + 1 for a, b in box_ranges(40.0, 10.0, 45.0, 20.0)) / LATTICE**2
    assert small <= 4 * 50
    assert box_ranges(45.0, 20.0, 45.0, 20.0) and pytest.raises(ValueError, box_ranges, 10, 0, 5, 1)


def _scanned_rows(df):
    df.collect()
    nodes, rows = [df._jdf.queryExecution().executedPlan()], 0
    while nodes:
        node = nodes.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            nodes.append(node.executedPlan())
        if node.nodeName().startswith("Scan parquet"):
            rows += node.metrics().apply("numOutputRows").value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
        if "QueryStage" in node.nodeName():
            nodes.append(node.plan())
    return rows


def test_a_box_reads_few_row_groups(spark, scratch):
    cells = spark.range(120 * 120).select((40 + 0.25 * (F.col("id") % 120)).alias("latitude"), (0.25 * F.floor(F.col("id") / 120)).alias("longitude"))
    raw = cells.selectExpr("timestamp'2020-06-01 10:00:00' time", "*", "280D t2m", "275D d2m", "1D u10", "2D v10", "100D cape", "500D blh", "95000D sp", "0.5D tcc")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.setInt("parquet.page.row.count.limit", 200)
    conf.setInt("parquet.block.size", 40_000)
    try:
        write_transformed(transform(raw), f"{scratch}/zone", tile_degrees=64)
    finally:
        conf.unset("parquet.page.row.count.limit")
        conf.unset("parquet.block.size")
    assert len(glob.glob(f"{scratch}/zone/version=*/year=*/month=*/*.parquet")) <= 4
    zone = read_transformed(spark, f"{scratch}/zone")
    near = in_box(zone, 45.0, 5.0, 47.0, 7.0)
    assert near.count() == 9 * 9 and {r.latitude for r in near.select("latitude").collect()} == {45 + k / 4 for k in range(9)}
    assert _scanned_rows(near.select("latitude")) < zone.count() / 4
    assert in_box(zone.drop("cell_id"), 45.0, 5.0, 47.0, 7.0).count() == 81


def _plain_nearest(sites, cells, within):
    out = {}
    for name, la, lo in sites:
        if la is None or lo is None or math.isnan(la):
            continue
        found = []
        for a, o in cells:
            apart = abs(lo - o) % 360
            d = math.hypot(la - a, min(apart, 360 - apart) * math.cos(math.radians(la)))
            if d <= within:
                found.append((round(d, 9), a, o))
        if found:
            out[name] = min(found)[0]
    return out


def test_nearest_cells_equal_brute_force(spark):
    rng = random.Random(8)
    cells = [(a / 2, o / 2) for a in range(-180, 181, 3) for o in range(-360, 361, 5)]
    sites = [(i, rng.uniform(-90, 90), rng.uniform(-200, 380)) for i in range(150)]
    sites += [(900, None, 1.0), (901, 1.0, None), (902, NAN, 1.0), (903, 89.9, 10.0), (904, -89.99, -170.0), (905, 0.75, 0.0), (906, 0.0, 180.0), (907, 0.0, -180.0), (908, 0.75, 0.0)]
    grid = add_cell_id(spark.createDataFrame(cells, "latitude double, longitude double"))
    frame = spark.createDataFrame(sites, "name int, lat double, lon double")
    for within in (0.4, 2.0):
        got = {r.name: r for r in nearest_cells(frame, grid, within).collect()}
        want = _plain_nearest(sites, cells, within)
        assert len(got) == len(sites)
        for name, r in got.items():
            assert (r.cell_distance is None) == (name not in want), (name, r)
            if name in want:
                assert abs(r.cell_distance - want[name]) < 1e-8, (name, r)
    tie = nearest_cells(frame.filter("name IN (905, 908)"), grid, 2.0).collect()  # half way between two cells
    assert {(r.cell_latitude, r.cell_longitude) for r in tie} == {(0.0, 0.0)}
    assert nearest_cells(frame.limit(0), grid).count() == 0 and nearest_cells(frame, grid.limit(0)).filter("cell_id IS NOT NULL").count() == 0


def test_sites_join_cells_by_tiles(spark):
    grid = grid_positions(transform(fixtures.grid_raw(spark, SF_SMALL)))
    sites = fixtures.weather_events(spark, SF_SMALL).select("location", "lat", "lon").distinct()
    found = nearest_cells(sites, grid, 0.6)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    base = site_baseline(transform(fixtures.grid_raw(spark, SF_SMALL)), found)
    # at this size some cells have no rows: the brute-force key s4_nearest_cells checks the rest
    near = {r.location for r in found.filter("cell_id IS NOT NULL").collect()}
    assert near and {r.hist_location for r in base.select("hist_location").distinct().collect()} == near


def _site_grid(spark):
    rows = [(a, o, 1 + k % 12, k % 24, None if k % 5 == 0 else k * 0.37, None if (a, k % 24) == (44.0, 3) else k * 11.3)
            for k in range(700) for a, o in ((43.0, 20.0), (44.0, 20.5), (45.0, 21.0))]
    rows += [(None, 20.0, 6, 3, 9.0, 9.0), (NAN, 20.0, 6, 3, 9.0, 9.0), (-0.0, 0.0, 6, 3, 1.0, 2.0), (0.0, -0.0, 6, 3, 4.0, 5.0)]
    grid = spark.createDataFrame(rows, "latitude double, longitude double, month int, hour int, wind_speed double, cloud_base_m double")
    return grid, rows


def test_site_baseline_equals_plain_means(spark):
    grid, rows = _site_grid(spark)
    sites = spark.createDataFrame([("a", 43.1, 20.0), ("b", 42.9, 20.1), ("c", 44.0, 20.5), ("zero", 0.1, 0.1), ("far", -60.0, 0.0), (None, 45.0, 21.0)],
                                  "location string, lat double, lon double")
    cell = {"a": (43.0, 20.0), "b": (43.0, 20.0), "c": (44.0, 20.5), "zero": (0.0, 0.0), None: (45.0, 21.0)}
    mean = lambda xs: sum(xs) / len(xs) if xs else None
    want = {}
    for name, at in cell.items():
        for hour in range(24):
            mine = [r for r in rows if r[:2] == at and r[3] == hour and 4 <= r[2] <= 9]
            if mine:
                want[name, hour] = [mean([r[i] for r in mine if r[i] is not None]) for i in (4, 5)]
    for obs in (grid, add_cell_id(grid)):  # ids are made, or the rows have them
        found = nearest_cells(sites, grid_positions(obs), 0.6)
        got = {(r.hist_location, r.hist_hour): (r.hist_wind, r.hist_cloud_base) for r in site_baseline(obs, stored(found, "nearest")).collect()}
        assert got.keys() == want.keys()
        for k, pair in want.items():
            assert all((x is None) == (y is None) and (x is None or abs(x - y) <= 0.0051) for x, y in zip(got[k], pair)), k


def test_site_baseline_moves_neither_rows_nor_events(spark):
    import __spark_entry__ as entry

    grid, _ = _site_grid(spark)
    near = stored(spark.createDataFrame([("a", 43.0, 20.0)], "location string, latitude double, longitude double").transform(add_cell_id).select("location", "cell_id"), "nearest")
    for obs in (grid, add_cell_id(grid)):  # ids are made, or the rows have them
        assert "SortMergeJoin" not in site_baseline(obs, near)._jdf.queryExecution().executedPlan().toString()
    plan = entry.queries()["s4_site_baseline"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert plan.count("events.parquet") == 1 and "lineitem" not in plan
