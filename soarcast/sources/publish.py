"""Tables that are replaced as a whole: versioned folders and a manifest that is swapped last.

A table is a folder. Each write goes to a new folder ``version=<id>`` in it, with a ``year=`` folder
for each year of a table that is kept by year, and touches nothing that readers use. When the write is done, the
manifest ``_manifest.json`` is written beside the old one and renamed over it, which is one atomic
step of the file system. Readers resolve the manifest once, when they build their query, so they
see one committed version: the old one while a write runs or after one was killed half-way, the
new one after it. The version before the current one is kept for queries that were built on it,
older ones are removed.

One writer at a time may commit to a table; a commit whose manifest has changed since the write
began fails instead of losing the other's.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

MANIFEST, VERSION = "_manifest.json", "version"
#: how Spark names the folder of rows without a year
NO_YEAR = "__HIVE_DEFAULT_PARTITION__"


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path in it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _child(spark: SparkSession, path: str, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")


class Published:
    """The versions of one table folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.manifest = self._read()

    def _read(self) -> dict:
        fs, _ = _file_system(self.spark, self.path)
        name = _child(self.spark, self.path, MANIFEST)
        if not fs.exists(name):
            return {}
        stream = fs.open(name)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    @property
    def exists(self) -> bool:
        """Whether any version was committed."""
        return bool(self.manifest)

    @property
    def parts(self) -> dict[str, str]:
        """Current folder of each part, below the table's folder. A part is a year, or ``""`` for all."""
        return dict(self.manifest.get("parts", {}))

    @property
    def notes(self) -> dict[str, str]:
        """What the writer noted of each part when it was committed."""
        return dict(self.manifest.get("notes", {}))

    def folder(self, part: str = "") -> str:
        return f"{self.path}/{self.parts[part]}"

    def commit(self, parts: dict[str, str], notes: dict[str, str] | None = None) -> None:
        """Make ``parts`` the current version, then remove folders that neither it nor the last one uses."""
        if self._read() != self.manifest:
            raise RuntimeError(f"another write to {self.path} was committed meanwhile; run this one again")
        spark, jvm = self.spark, self.spark._jvm
        fs, _ = _file_system(spark, self.path)
        before = self.parts
        new = {"id": uuid.uuid4().hex, "parts": parts, "previous": before, "notes": notes or {}}
        staged, final = _child(spark, self.path, f"{MANIFEST}.{new['id']}"), _child(spark, self.path, MANIFEST)
        fs.mkdirs(final.getParent())
        out = fs.create(staged, True)
        try:
            out.write(bytearray(json.dumps(new, indent=1, sort_keys=True).encode()))
        finally:
            out.close()
        replace = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        replace[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(
            fs.makeQualified(staged), fs.makeQualified(final), replace)
        kept = set(parts.values()) | set(before.values())
        for folder in set(self.manifest.get("previous", {}).values()) - kept:
            fs.delete(_child(spark, self.path, folder), True)
        self.manifest = new

    def _new_years(self, version: str) -> dict[str, str]:
        """Years of which ``version`` has a folder."""
        fs, _ = _file_system(self.spark, self.path)
        found = fs.globStatus(_child(self.spark, self.path, f"{VERSION}={version}/year=*")) or []
        names = [status.getPath().getName() for status in found]
        return {n.removeprefix("year="): f"{VERSION}={version}/{n}" for n in names}

    def replace_all(self, df: DataFrame, by: Iterable[str] = (), notes: dict[str, str] | None = None, **options) -> None:
        """Write ``df`` as the whole table. With ``by`` = ("year", ...) it is kept by year."""
        version, by = uuid.uuid4().hex[:16], list(by)
        df.write.options(**options).partitionBy(*by).parquet(f"{self.path}/{VERSION}={version}")
        self.commit(self._new_years(version) if by else {"": f"{VERSION}={version}"}, notes)

    def replace_years(self, frames: dict[str, DataFrame | None], by: Iterable[str] = (), notes: dict[str, str] | None = None,
                      **options) -> None:
        """Write each year's rows (without their ``year`` column) as that whole year and commit all at once.

        A year given as None leaves the table. Rows without a year are the year ``NO_YEAR``.
        """
        parts, version = self.parts, uuid.uuid4().hex[:16]
        fs, _ = _file_system(self.spark, self.path)
        if "" in parts or not self.exists and fs.globStatus(_child(self.spark, self.path, "year=*")):
            raise ValueError(f"{self.path} is not kept by year in versions; write it as a whole once")
        for year, df in frames.items():
            parts.pop(str(year), None)
            if df is not None:
                folder = f"{VERSION}={version}/year={year}"
                df.write.options(**options).partitionBy(*by).parquet(f"{self.path}/{folder}")
                parts[str(year)] = folder
        self.commit(parts, notes)

    def read(self, schema: StructType | None = None, years: Iterable[int] | None = None) -> DataFrame:
        """The committed version; ``years`` lists those years' folders only.

        A folder without a manifest (written before tables were versioned) is read as it is.
        """
        reader = self.spark.read
        if not self.exists:
            reader = reader.schema(schema) if schema else reader
            rows = reader.parquet(self.path)
            return rows if years is None else rows.filter(F.col("year").isin([int(y) for y in years]))
        parts = self.parts
        if years is not None:
            parts = {y: parts[y] for y in map(str, sorted({int(y) for y in years})) if y in parts}
        if schema:
            reader = reader.schema(StructType([*schema.fields, StructField(VERSION, StringType())]))
        if not parts:
            if schema is None:
                raise ValueError(f"{self.path} has no rows, so its columns are unknown")
            return self.spark.createDataFrame([], schema)
        folders = [f"{self.path}/{folder}" for folder in parts.values()]
        return reader.option("basePath", self.path).parquet(*folders).drop(VERSION)


def committed_batches(spark: SparkSession, root: str, table: str, schema: StructType | None = None) -> DataFrame | None:
    """Rows of a live Parquet sink (``streaming.parquet_batch_writer``), of finished batches only.

    A batch counts when its folder holds the success marker that Spark writes last. None when
    no batch is finished yet and no ``schema`` is given.
    """
    base = f"{root.rstrip('/')}/{table}"
    fs, _ = _file_system(spark, base)
    done = [s.getPath().getParent().toString() for s in fs.globStatus(_child(spark, base, "query_id=*/batch_id=*/_SUCCESS")) or []]
    if not done:
        return spark.createDataFrame([], schema) if schema else None
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.option("basePath", base).parquet(*done)
