"""Folders that the driver and all executors share, and tables in them that cut a lineage."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new folder in the one that the cluster names in spark.checkpoint.dir; all executors see it.

    Only in local mode, where everything runs on one machine, a folder of this
    machine stands in for a missing setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
        import tempfile

        root = getattr(shared_dir, "own", None)
        if root is None:
            root = shared_dir.own = "file://" + tempfile.mkdtemp(prefix="panelforge-")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def _folder(path: str, spark: SparkSession):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def dropped(path: str, spark: SparkSession) -> None:
    """Deletes a folder, through Spark's own file system layer."""
    system, path = _folder(path, spark)
    system.delete(path, True)


def until_exit(path: str, spark: SparkSession) -> str:
    """The folder, which goes when the driver ends: a lazy result may read it until then."""
    system, folder = _folder(path, spark)
    system.deleteOnExit(folder)
    return path


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, Spark deletes a query's shuffle files when it ends, not when the driver happens to collect its garbage.

    For queries whose result is a table: nothing reads the shuffles again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """The rows as a table in a new shared folder, and the folder, which goes when the driver ends if not before."""
    spark = df.sparkSession
    path = shared_dir(spark)
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(until_exit(path, spark)), path


def bucketed(df: DataFrame, n: int, keys: list[str], order: tuple[str, ...] = ()) -> DataFrame:
    """The rows as a table in a new shared folder, in n buckets by keys: joins on all keys read it without a shuffle.

    df should be dealt to n partitions by the keys, so that a bucket is a file. The catalog knows the table only
    until it has been opened; the folder goes when the driver ends.
    """
    spark = df.sparkSession
    name, path = f"panelforge_{uuid.uuid4().hex}", shared_dir(spark)
    with freed_shuffles(spark):
        df.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(n, *keys).sortBy(*keys, *order).saveAsTable(name)
    until_exit(path, spark)
    try:
        return spark.read.table(name)
    finally:
        spark.sql(f"drop table {name}")  # it is an external one: the files stay
