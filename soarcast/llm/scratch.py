"""Tables that cut lineage: written to the cluster's shared folder and read again.

The folder is ``spark.checkpoint.dir`` of the session, which driver and executors share, so
a lost executor costs no more than its running tasks. Where the setting is absent (tests on
one machine) the context's checkpoint folder is used, and where that is absent too, a new
folder under the machine's temp folder is set, on a local master only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The shared folder of this session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        root = context.getCheckpointDir()
        if not root:
            if not context.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir is not set; point it at a folder that all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
            root = context.getCheckpointDir()
    return root.rstrip("/")


def free_names(columns: list[str], *names: str) -> list[str]:
    """``names``, each with as many underscores added as it takes not to clash (in any case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def let_workers_import(spark: SparkSession) -> None:
    """Put this package's folder on the Python workers' path, as the driver found it.

    On a cluster the package is installed or sent with ``--py-files`` and this changes nothing;
    where a driver only put a folder on ``sys.path``, its local workers need it as well.
    """
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, home])


class Scratch:
    """A fresh folder of one run in the shared folder; its tables are named by the caller."""

    def __init__(self, spark: SparkSession, name: str):
        let_workers_import(spark)
        self.spark = spark
        self.run = uuid.uuid4().hex[:12]
        self.root = f"{shared_root(spark)}/llm-{name}-{self.run}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return the written table."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))
