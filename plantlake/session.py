"""Session helpers: UTC timestamps, checkpoints and shared scratch folders."""

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Plant timestamps are UTC; local time appears only through explicit zone columns."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def require_utc(spark: SparkSession) -> None:
    """Refuse a session in another zone, in which dates of partitions and bounds of ranges would not agree."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"plant timestamps are UTC but the session's zone is {zone}; call use_utc(spark)")


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local-mode session without that setting gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="plantlake-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of `df` with a reliable checkpoint."""
    spark = df.sparkSession
    root = shared_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint(eager=True)


@contextmanager
def set_within(spark: SparkSession, settings: dict[str, str]):
    """Settings of the session for the actions of a block; what was set before comes back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return os.path.join(shared_root(spark), "plantlake", f"{name}-{uuid.uuid4().hex}")


def _at(spark: SparkSession, path: str):
    """A path and the file system that holds it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    place, files = _at(spark, path)
    return files.exists(place)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder; none if it does not exist."""
    place, files = _at(spark, path)
    return [s.getPath().getName() for s in files.listStatus(place) if s.isDirectory()] if files.exists(place) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    place, files = _at(spark, path)
    files.delete(place, True)
