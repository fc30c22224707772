"""Readers see one committed version, whatever a writer does or fails to do."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from soarcast.functions import transform
from soarcast.sources import Published, committed_batches, fixtures, read_mart, read_transformed, replace_zone_years, write_mart, write_transformed
from soarcast.streaming import parquet_batch_writer


def _numbers(df):
    return sorted(r.x for r in df.collect())


def _frame(spark, *xs):
    return spark.createDataFrame([(x,) for x in xs], "x int")


def test_a_reader_keeps_the_version_it_resolved(spark, scratch):
    write_mart(_frame(spark, 1, 2), scratch, "m")
    old = read_mart(spark, scratch, "m")
    write_mart(_frame(spark, 3), scratch, "m")
    assert _numbers(old) == [1, 2] and _numbers(read_mart(spark, scratch, "m")) == [3]
    write_mart(_frame(spark, 4), scratch, "m")
    assert _numbers(read_mart(spark, scratch, "m")) == [4]
    assert len(glob.glob(f"{scratch}/m/version=*")) == 2  # the current one and the one before


def test_a_write_that_dies_half_way_changes_nothing(spark, scratch):
    write_mart(_frame(spark, 1, 2), scratch, "m")
    dying = spark.range(4).repartition(4).select(
        F.when(F.col("id") == 3, F.raise_error(F.lit("killed")).cast("int")).otherwise(F.col("id").cast("int")).alias("x"))
    with pytest.raises(Exception, match="killed"):
        write_mart(dying, scratch, "m")
    assert _numbers(read_mart(spark, scratch, "m")) == [1, 2]
    # killed after its files were written but before the manifest was swapped
    with open(f"{scratch}/m/_manifest.json.half", "w") as out:
        out.write("{")
    os.makedirs(f"{scratch}/m/version=half")
    with open(f"{scratch}/m/version=half/part-0.parquet", "wb") as out:
        out.write(b"torn")
    assert _numbers(read_mart(spark, scratch, "m")) == [1, 2]


def test_zone_overwrites_are_atomic(spark, scratch):
    obs = transform(fixtures.grid_raw(spark, SF_SMALL).drop("obs_id"))
    write_transformed(obs, f"{scratch}/zone")
    reader = read_transformed(spark, f"{scratch}/zone")
    n = reader.count()
    write_transformed(obs.filter("year <> 1996"), f"{scratch}/zone")
    assert reader.count() == n and read_transformed(spark, f"{scratch}/zone").filter("year = 1996").count() == 0
    # two years in one commit: a failure in the second leaves the first as it was
    broken = obs.withColumn("cape", F.when(F.col("year") == 1998, F.raise_error(F.lit("killed")).cast("double")).otherwise(F.lit(-1.0)))
    with pytest.raises(Exception, match="killed"):
        replace_zone_years(broken, f"{scratch}/zone", [1997, 1998])
    assert read_transformed(spark, f"{scratch}/zone").filter("cape = -1").count() == 0
    years = read_transformed(spark, f"{scratch}/zone", years=[1997, 1999])
    assert {r.year for r in years.select("year").distinct().collect()} == {1997, 1999}
    assert "year=1995" not in str(years.inputFiles())


def test_a_second_writer_does_not_undo_the_first(spark, scratch):
    write_mart(_frame(spark, 1), scratch, "m")
    first, second = Published(spark, f"{scratch}/m"), Published(spark, f"{scratch}/m")
    first.replace_all(_frame(spark, 2))
    with pytest.raises(RuntimeError, match="another write"):
        second.replace_all(_frame(spark, 3))
    assert _numbers(read_mart(spark, scratch, "m")) == [2]


def test_folders_without_a_manifest(spark, scratch):
    obs = transform(fixtures.grid_raw(spark, SF_SMALL).drop("obs_id"))
    obs.write.partitionBy("year", "month").parquet(f"{scratch}/zone")
    old = read_transformed(spark, f"{scratch}/zone")
    assert old.filter("cell_id IS NULL").count() == 0 and old.count() == obs.count()
    with pytest.raises(ValueError, match="as a whole once"):
        replace_zone_years(obs, f"{scratch}/zone", [1996])
    empty = Published(spark, f"{scratch}/nothing")
    empty.replace_all(obs.limit(0), ("year", "month"))
    assert read_transformed(spark, f"{scratch}/nothing").count() == 0


def test_live_sinks_show_finished_batches_only(spark, scratch):
    assert committed_batches(spark, scratch, "t") is None
    write = parquet_batch_writer(scratch, "t")
    write(_frame(spark, 1, 2), 0)
    write(_frame(spark, 3), 1)
    torn = f"{scratch}/t/query_id=batch/batch_id=2"
    os.makedirs(torn)
    with open(f"{torn}/part-0.parquet", "wb") as out:
        out.write(b"torn")
    done = committed_batches(spark, scratch, "t")
    assert _numbers(done) == [1, 2, 3] and sorted({r.batch_id for r in done.collect()}) == [0, 1]
    assert committed_batches(spark, scratch, "none", _frame(spark, 1).schema).count() == 0
