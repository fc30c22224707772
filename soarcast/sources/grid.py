"""Grid zones on shared storage: raw (partitioned by ``year=``) and transformed
(partitioned by ``year``/``month``)."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Sequence
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from ..functions.cells import CELL, LATTICE_BITS, add_cell_id, with_cell_id
from ..functions.derive import as_doubles
from ..functions.timecols import normalize_time
from ..schemas import OBS_SCHEMA, RAW_AUXILIARY, RAW_VARIABLES
from ..session import NANOS_AS_LONG, session_settings
from .publish import Published


def read_raw(spark: SparkSession, path: str, years: Iterable[int] | None = None) -> DataFrame:
    """Scan the raw zone. ``years`` filters the ``year=`` partition folders *before*
    the transform recomputes ``year`` from the time, so only those folders are listed
    and read.

    Grids are stored in single or double precision, with the time as timestamp (INT96 or INT64),
    epoch nanoseconds or nanosecond timestamps, and years of one zone may differ. ``schema_groups``
    takes a census of all footers, each group of files with like types is read with its own
    explicit schema, and the groups are united: variables as doubles, the time as a timestamp where
    groups differ. So no result depends on which footer is read first. Nanosecond timestamps are
    read as bigints, in a session that ``build_session`` made or within ``session.utc_session``.
    """
    wanted = None if years is None else {int(y) for y in years}
    with session_settings(spark, NANOS_AS_LONG):
        groups = schema_groups(spark, path, wanted)
    frames = []
    for files, schema in groups:
        df = spark.read.option("basePath", path).schema(schema).parquet(*files)
        df = _variables_as_doubles(df.drop(*[c for c in RAW_AUXILIARY if c in df.columns]))
        frames.append(normalize_time(df, "time") if len(groups) > 1 and "time" in df.columns else df)
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return df if wanted is None else df.filter(F.col("year").isin(sorted(wanted)))


def _variables_as_doubles(df: DataFrame) -> DataFrame:
    known = [c for c in (*RAW_VARIABLES, "latitude", "longitude") if c in df.columns and not isinstance(df.schema[c].dataType, DoubleType)]
    return as_doubles(df.withColumns({c: F.col(c).cast("double") for c in known}) if known else df)


def schema_groups(spark: SparkSession, path: str, years: set[int] | None = None) -> list[tuple[list[str], StructType]]:
    """Files of a Parquet folder in groups whose footers agree, each with its schema.

    Spark merges all footers of a folder in one distributed job. Where types conflict, the files,
    in order of their paths, are halved until each part agrees, so a zone with a few changes of type
    over the years takes a few jobs for each; parts with the same schema are one group.
    Folders that belong to one group as a whole are named as folders.
    """
    files = sorted(unquote(f) for f in spark.read.parquet(path).inputFiles())
    if years is not None:
        folder = {f: re.search(r"/year=(-?\d+)/", f) for f in files}
        files = [f for f in files if not folder[f] or int(folder[f].group(1)) in years] or files[:1]
    first = _agreed(spark, path, files)
    groups: dict[str, tuple[list[str], StructType]] = {}
    for part, schema in first:
        groups.setdefault(schema.json(), ([], schema))[0].extend(part)
    if len(groups) == 1 and years is None:
        return [([path], schema) for _, schema in groups.values()]
    in_folder = Counter(f.rsplit("/", 1)[0] for f in files)
    return [(_as_folders(part, in_folder), schema) for part, schema in groups.values()]


def _agreed(spark: SparkSession, path: str, files: list[str]) -> list[tuple[list[str], StructType]]:
    try:
        return [(files, spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*files).schema)]
    except (PySparkException, Py4JJavaError) as error:
        if len(files) == 1 or "CANNOT_MERGE" not in str(error):
            raise
        half = len(files) // 2
        return _agreed(spark, path, files[:half]) + _agreed(spark, path, files[half:])


def _as_folders(files: list[str], in_folder: Counter) -> list[str]:
    mine = Counter(f.rsplit("/", 1)[0] for f in files)
    whole = {d for d, n in mine.items() if n == in_folder[d]}
    return sorted(whole) + [f for f in files if f.rsplit("/", 1)[0] not in whole]


#: edge of a spatial tile in degrees; a tile-month should be a few files of advisory size
TILE_DEGREES = 4.0


def _laid_out(rows: DataFrame, keys: Sequence[str], tile_degrees: float, rebalance: bool) -> DataFrame:
    """Rows of one tile in one task (AQE splits and joins tasks by size), sorted by cell and time.

    A tile is a prefix of the cell id, with edges of ``tile_degrees`` or the next power of two.
    A tile-month in one file holds its cells with all their hours, so aggregations by cell or
    cell-day combine hundreds of rows to one before they shuffle, and a range of ids is a range of
    row groups. ``rebalance=False`` only sorts.
    """
    if rebalance:
        bits = 2 * (LATTICE_BITS + math.ceil(math.log2(tile_degrees)))
        rows = rows.withColumn("_tile", F.shiftright(CELL, bits)).hint("rebalance", *keys, "_tile").drop("_tile")
    return rows.sortWithinPartitions(*keys, CELL, "time")


def write_transformed(obs: DataFrame, path: str, max_records_per_file: int = 0, tile_degrees: float = TILE_DEGREES,
                      rebalance: bool = True) -> None:
    """Publish the zone anew, partitioned by ``year, month``, with the cell id of every row.

    One shuffle on (year, month, tile) makes the files independent of how the input is split;
    a month or tile that holds a third of all rows is split by size. ``rebalance=False`` skips
    that shuffle: use it when every input task holds one month of few tiles, as in a raw zone
    that ``replace_year`` wrote. Readers see the old zone until the new one is committed.
    """
    out = _laid_out(with_cell_id(obs), ("year", "month"), tile_degrees, rebalance)
    Published(obs.sparkSession, path).replace_all(out, ("year", "month"), maxRecordsPerFile=int(max_records_per_file))


def replace_zone_years(obs: DataFrame, path: str, years: Iterable[int], tile_degrees: float = TILE_DEGREES, rebalance: bool = True) -> None:
    """Replace ``years`` of the zone by their rows in ``obs``, all at once.

    Each year is replaced as a whole, so its months are exactly those of ``obs``.
    """
    frames = {}
    for year in sorted({int(y) for y in years}):
        rows = with_cell_id(obs.filter(F.col("year") == year))
        frames[year] = _laid_out(rows, ("month",), tile_degrees, rebalance).drop("year")
    Published(obs.sparkSession, path).replace_years(frames, ("month",))


def replace_zone_year(obs: DataFrame, path: str, year: int, tile_degrees: float = TILE_DEGREES, rebalance: bool = True) -> None:
    """Replace one year of the zone by its rows in ``obs``."""
    replace_zone_years(obs, path, [year], tile_degrees, rebalance)


def read_transformed(spark: SparkSession, path: str, years: Iterable[int] | None = None) -> DataFrame:
    """The committed zone with its explicit schema; month/year filters prune folders, and
    ``years`` keeps other years from being listed at all."""
    return observations(Published(spark, path), years)


def observations(zone: Published, years: Iterable[int] | None = None) -> DataFrame:
    """Rows of a zone version; ids are made for a zone that was written before it had them."""
    rows = zone.read(OBS_SCHEMA, years)
    return rows if zone.exists else add_cell_id(rows)


def flatten_cube(cube: DataFrame, dims: Sequence[str], variables: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Long rows from gridded cubes: one row per cell of each cube.

    ``cube`` holds one row per cube with an array per dimension (``dims``, outer to
    inner, e.g. time, latitude, longitude) and, per variable, a nested array of the
    same shape. Each cube is exploded in its own task, dimension by dimension; the
    result has the dimension values, the variables, and ``keys`` copied from the cube.
    One cube row is one task's work, so feed time slices (e.g. one row per time step or
    day), not a whole year in one row; the slices then spread over the cluster.
    """
    df = cube.select(*keys, *[F.col(d).alias(f"_dim_{d}") for d in dims], *variables)
    for d in dims:
        df = df.select(
            "*", F.posexplode(F.col(f"_dim_{d}")).alias(f"_i_{d}", d)
        ).drop(f"_dim_{d}")
        df = df.select(
            *[c for c in df.columns if c not in variables],
            *[F.get(F.col(v), F.col(f"_i_{d}")).alias(v) for v in variables],
        ).drop(f"_i_{d}")
    return df.drop(*[c for c in RAW_AUXILIARY if c in df.columns])


def replace_year(rows: DataFrame, path: str, year: int, tile_degrees: float = TILE_DEGREES) -> None:
    """Replace one ``year=`` folder of the raw zone; other years are left untouched.

    Files are laid out by month and tile like the transformed zone, so a later transform may
    skip its own shuffle (``rebalance=False``).
    """
    rows = normalize_time(rows.drop("year"), "time").withColumns({"year": F.lit(int(year)), "_month": F.month("time")})
    (
        _laid_out(add_cell_id(rows), ("_month",), tile_degrees, True)
        .drop("_month", CELL)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year")
        .parquet(path)
    )
