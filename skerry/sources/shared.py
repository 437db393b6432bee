"""Tables that a job writes to the folder that driver and executors share, and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the folder set on the context; a cluster without either is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is unset: it must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="skerry-")  # one process, so tasks see the driver's folder
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, name: str):
    """The Hadoop path of a name and its file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def removed(spark: SparkSession, name: str) -> None:
    path, system = hadoop_path(spark, name)
    system.delete(path, True)


class Rounds:
    """Tables of an iterative job: put() writes one and cuts its lineage there, drop() frees those that no later round reads."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.count = spark, new_path(spark, name), 0
        self.paths: dict[int, str] = {}

    def put(self, d: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        d.write.parquet(path)
        out = self.spark.read.schema(d.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for d in tables:
            removed(self.spark, self.paths.pop(id(d)))
