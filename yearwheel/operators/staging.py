"""Small intermediate tables written to the cluster's shared folder.

An extract reads its fact tables once. What it needs more than once afterwards (quarterly totals,
rolling-year base, dimension members) is small, so it is written out: the lineage back to the fact
scan is cut, a lost executor costs nothing, and Spark sees the true size of the table when it plans
the joins that follow.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, tempfile.TemporaryDirectory] = {}

# A staged table does not go back to the shuffles it was made from, so their files need not wait for the driver's garbage collection.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside remove their shuffle files when they end."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only for a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.TemporaryDirectory(prefix="yearwheel-", ignore_cleanup_errors=True)
    return _local_folders[app].name


class Staging:
    """Write DataFrames below one fresh folder and hand back readers of them."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = f"{folder or shared_folder(spark)}/yearwheel-{uuid.uuid4().hex}"

    def __call__(self, df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
        """``by`` names columns with few values; a reader that filters on them opens only the files it needs."""
        path = f"{self.folder}/{name}"
        with shuffles_removed(self.spark):
            df.write.mode("errorifexists").partitionBy(*by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete the staged tables, or those named; readers handed out before are then invalid."""
        for path in [f"{self.folder}/{name}" for name in names] or [self.folder]:
            self._delete(path)

    def _delete(self, folder: str) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_: object) -> None:
        self.drop()
