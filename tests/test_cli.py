"""The command line runs the pipeline the way spark-submit jobs would."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from soarcast.__main__ import main
from soarcast.sources import fixtures


def test_cli_transform_marts_and_live(spark, scratch):
    raw = fixtures.grid_raw(spark, SF_SMALL).drop("obs_id")
    raw.withColumn("year", F.year("time")).write.partitionBy("year").parquet(f"{scratch}/raw")
    fixtures.event_messages(spark, SF_SMALL).select("value").write.text(f"{scratch}/msgs")

    assert main(["transform", "--raw", f"{scratch}/raw", "--zone", f"{scratch}/zone"], spark) == 0
    assert main(["marts", "--zone", f"{scratch}/zone", "--marts-root", f"{scratch}/marts",
                 "q3_hourly_conditions", "q2_location_stability"], spark) == 0
    assert sorted(n for n in os.listdir(f"{scratch}/marts") if n[0] != "_") == ["q2_location_stability", "q3_hourly_conditions"]
    assert spark.read.parquet(f"{scratch}/marts/q3_hourly_conditions").count() == 24

    assert main(["live", "--marts-root", f"{scratch}/marts", "--sink-root", f"{scratch}/live",
                 "--source", f"{scratch}/msgs", "--checkpoint-dir", f"{scratch}/ckpt",
                 "--trigger", "available-now", "--state-partitions", "4"], spark) == 0
    assert spark.read.parquet(f"{scratch}/live/historical_comparison").count() == 1000


def test_cli_ingest_replaces_one_year(spark, scratch):
    import datetime as dt

    times = [dt.datetime(2021, 7, 1, h) for h in (10, 11)]
    lats, lons = [45.0, 44.75], [20.0, 20.25, 20.5]

    def grid(base):
        return [[[base + t + a * 0.1 + o * 0.01 for o in range(3)] for a in range(2)] for t in range(2)]

    cols = {"t2m": 290.0, "d2m": 280.0, "u10": 2.0, "v10": 1.0, "cape": 400.0, "blh": 1200.0, "sp": 95000.0,
            "tcc": 0.1}
    schema = ("time array<timestamp>, latitude array<double>, longitude array<double>, "
              + ", ".join(f"{c} array<array<array<double>>>" for c in cols))
    cube = spark.createDataFrame([(times, lats, lons, *[grid(v) for v in cols.values()])], schema)
    cube.write.parquet(f"{scratch}/cubes")
    assert main(["ingest", "--cubes", f"{scratch}/cubes", "--raw", f"{scratch}/raw", "--year", "2021"], spark) == 0
    raw = spark.read.parquet(f"{scratch}/raw")
    assert raw.count() == 12 and raw.select("year").distinct().first()[0] == 2021
    assert main(["transform", "--raw", f"{scratch}/raw", "--zone", f"{scratch}/zone"], spark) == 0
    assert spark.read.parquet(f"{scratch}/zone").count() == 12
