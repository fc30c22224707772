"""Physical-plan properties the scale design relies on."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from soarcast import oracle
from soarcast.functions import transform
from soarcast.operators import global_rank, hourly_baseline
from soarcast.plans import build_marts, marts
from soarcast.plans.state import state_table
from soarcast.sources import fixtures, read_transformed, write_transformed
from soarcast.streaming import views


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_no_python_evaluation_in_any_query(spark):
    for key in oracle.QUERIES:  # the training-data operators have rules of their own
        plan = _plan(E.queries()[key](spark, SF_SMALL))
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert node not in plan, (key, node)


def test_month_filter_prunes_partitions_and_hours_push_down(spark, scratch):
    write_transformed(transform(fixtures.grid_raw(spark, SF_SMALL)), f"{scratch}/zone")
    obs = read_transformed(spark, f"{scratch}/zone")
    plan = _plan(marts.category_by_hour(obs))
    assert "PartitionFilters: [isnotnull(month" in plan and "(month#" in plan
    pushed = plan[plan.index("PushedFilters: [IsNotNull(hour)"):]
    pushed = pushed[: pushed.index("ReadSchema")]
    assert "GreaterThanOrEqual(hour,6)" in pushed and "LessThanOrEqual(hour,21" in pushed
    scan = plan[plan.index("ReadSchema"):]
    assert "t2m" not in scan  # column pruning: only used columns are read


def test_morning_to_afternoon_needs_no_join(spark):
    plan = _plan(marts.morning_to_afternoon(E.observations(spark, SF_SMALL)))
    assert "Join" not in plan


def test_baseline_side_is_broadcast(spark):
    obs = E.observations(spark, SF_SMALL)
    out = views.versus_baseline(E.scored_events(spark, SF_SMALL), hourly_baseline(marts.hourly_conditions(obs)))
    optimized = _optimized(out)
    assert "BROADCAST" in optimized.upper()
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final


def test_cell_rank_is_not_a_single_partition_window(spark):
    plan = _optimized(marts.cell_stability(E.observations(spark, SF_SMALL)))
    # the only ordered window over all rows is the bucket prefix (<= buckets + 1 rows);
    # the per-value window is partitioned by bucket
    assert "_bucket" in plan
    assert "windowspecdefinition(_bucket" in plan


def test_no_global_sort_shuffle_in_marts_or_views(spark):
    """Calendar-sized results are ordered by a local sort in one partition; no query plans a
    range-partitioned sort (with its sampling job) before or after its windows."""
    obs = E.observations(spark, SF_SMALL)
    scored = E.scored_events(spark, SF_SMALL)
    frames = [fn(obs) for fn in marts.MARTS.values()]
    frames += [views.location_windows(scored), views.wind_trend(scored), views.point_alerts(scored),
               views.versus_baseline(scored, hourly_baseline(marts.hourly_conditions(obs)))]
    for df in frames:
        assert "rangepartitioning" not in _plan(df)


def test_zone_file_count_is_bounded_for_mixed_input(spark, scratch):
    """Input tasks that each mix every year and month must not write one file per
    task and folder (the small-file explosion a shuffle-free write would cause)."""
    import glob

    raw = fixtures.grid_raw(spark, SF_SMALL).drop("obs_id").repartition(16)  # every task mixes months
    write_transformed(transform(raw), f"{scratch}/zone")
    folders = glob.glob(f"{scratch}/zone/version=*/year=*/month=*")
    files = glob.glob(f"{scratch}/zone/version=*/year=*/month=*/*.parquet")
    assert len(files) <= 2 * len(folders)
    write_transformed(transform(raw), f"{scratch}/zone_plain", rebalance=False)
    plain = glob.glob(f"{scratch}/zone_plain/version=*/year=*/month=*/*.parquet")
    assert len(plain) > 4 * len(folders)  # what the rebalance prevents


def test_seven_marts_from_one_scan_equal_the_marts_themselves(spark, scratch):
    write_transformed(transform(fixtures.grid_raw(spark, SF_SMALL).drop("obs_id")), f"{scratch}/zone")
    obs = read_transformed(spark, f"{scratch}/zone")
    written = build_marts(spark, obs, f"{scratch}/marts")
    for name, path in written.items():
        got, want = spark.read.parquet(path), marts.MARTS[name](obs)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
    rollup = state_table(spark, f"{scratch}/marts", "calendar_rollup").read()
    for name in marts.ROLLUP_MARTS:
        counts = {c: 1 for c in marts.GRID_COUNT_MARTS.get(name, ())}
        plan = _plan(marts.MARTS[name](rollup, **counts, m=marts.Rollup))
        assert "calendar_rollup" in plan and f"{scratch}/zone" not in plan


def test_building_a_query_runs_no_job(spark, scratch):
    """Queries are lazy: no job starts while one is built (A4 writes a zone, which is its point)."""
    tracker = spark.sparkContext.statusTracker()
    write_transformed(transform(fixtures.grid_raw(spark, SF_SMALL)), f"{scratch}/zone")
    obs = read_transformed(spark, f"{scratch}/zone")
    spark.sparkContext.setJobGroup("lazy", "building queries")
    for build in marts.MARTS.values():
        build(obs)
    assert list(tracker.getJobIdsForGroup("lazy")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def _final_nodes(df):
    """Nodes of the executed plan after the run, subqueries included: (name, text of the node)."""
    df.collect()
    todo, out = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        name = node.nodeName()
        out.append((name, node.simpleString(1000)))
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        for children in (node.children(), node.subqueries()):
            todo += [children.apply(i) for i in range(children.size())]
    return out


def test_global_rank_shuffles_its_buckets_once(spark, scratch):
    spark.range(5000).select((F.col("id") % 997 * 1.5).alias("x")).write.parquet(f"{scratch}/x")
    nodes = _final_nodes(global_rank(spark.read.parquet(f"{scratch}/x"), "x", buckets=8))
    assert sum(name == "Exchange" and "REPARTITION_BY_COL" in text for name, text in nodes) == 1
    assert sum(name == "ReusedExchange" for name, _ in nodes) >= 2
    # one scan for the distinct values (quantiles, sizes and ranks share it), one for the rows they are joined to
    assert sum(name.startswith("Scan parquet") for name, _ in nodes) == 2
