"""Tables written to the shared folder so that later steps start from files.

A staged table cuts lineage, survives the loss of executors, has one fixed content however
often it is read, and gives the planner its true size.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder that the session names for such files. If it names none, one in the warehouse,
    where driver and executors are one machine; a cluster has to name one that all of them reach."""
    configured = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"{_SETTING} has to name a folder that all machines of {master} reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/_staging"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that name, on whatever file system holds it."""
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(name)


class Staging:
    """A folder of its own under ``root``, or under the session's shared folder.

    As a context manager it removes the folder at the end, but keeps it after an error, so that
    what was written can be looked at or taken over; otherwise the owner of a lazy result calls
    ``clear`` once the result has been written.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = f"{(root or shared_root(spark)).rstrip('/')}/shelfgap-{uuid.uuid4().hex}"
        self._steps: list[str] = []

    def new_path(self) -> str:
        return f"{self.root}/{uuid.uuid4().hex}"

    def save(self, df: DataFrame) -> DataFrame:
        path = self.new_path()
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def step(self, name: str, build: Callable[[], DataFrame]) -> tuple[DataFrame, bool]:
        """The rows that ``build`` makes, and whether an earlier run has left them.

        ``name`` has to tell the step's inputs and parameters. The files lie beside the folders of
        all runs; they are complete if the writer's mark of success is there, and are removed with
        the folder.
        """
        path = f"{os.path.dirname(self.root)}/shelfgap-step-{name}"
        self._steps.append(path)
        if path_exists(self.spark, f"{path}/_SUCCESS"):
            return self.spark.read.parquet(path), True
        df = build()
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), False

    def clear(self) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in (self.root, *self._steps):
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, kind: object, *_exc: object) -> None:
        if kind is None:
            self.clear()
