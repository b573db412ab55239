"""Tables in the shared folder, for what an operator reads more than once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesforge.session import checkpoint_dir


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.  Only where the session names none (local
    runs and tests) a temporary folder of this machine takes its place."""
    found = checkpoint_dir(spark)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="salesforge-")
        spark.sparkContext.setCheckpointDir(found)
        found = checkpoint_dir(spark)
    return found.rstrip("/")


def file_system(spark: SparkSession, path: str):
    """The store of a path (as Spark knows it) and the path in it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


class Scratch:
    """Parquet tables in the shared folder.

    A written table cuts the lineage: an executor that is lost later costs a read, not
    the work before it, and values such as row ids stay what they were.  ``release``
    deletes the tables as soon as nothing reads them; what is left goes when the session
    ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def folder(self, label: str) -> str:
        """A path of its own for files that are deleted with the others."""
        path = f"{shared_folder(self.spark)}/{label}-{uuid.uuid4().hex}"
        self.paths.append(path)
        fs, where = file_system(self.spark, path)
        fs.deleteOnExit(where)
        return path

    def table(self, df: DataFrame, label: str, **options) -> DataFrame:
        path = self.folder(label)
        df.write.options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def numbered(self, df: DataFrame) -> tuple[DataFrame, str]:
        """The rows with a written number of their own, and the name of that column."""
        rid = "rid"
        while rid in df.columns:
            rid += "_"
        return self.table(df.withColumn(rid, F.monotonically_increasing_id()), "rows"), rid

    def release(self, paths: list[str] | None = None) -> None:
        for path in list(self.paths if paths is None else paths):
            fs, where = file_system(self.spark, path)
            fs.delete(where, True)
            self.paths.remove(path)
