"""Files and folders by the file system that their path names, as tables are written; so reports lie beside their tables anywhere."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def place(spark: SparkSession, path: str):
    """(file system, path) as Hadoop has them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = place(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    fs, at = place(spark, path)
    fs.delete(at, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, at = place(spark, path)
    fs.mkdirs(at)


def move(spark: SparkSession, old: str, new: str) -> None:
    """Rename; an error if there is something at the new name already."""
    fs, at = place(spark, old)
    to = place(spark, new)[1]
    if fs.exists(to) or not fs.rename(at, to):
        raise FileExistsError(f"{old} was not moved to {new}")


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if there is none."""
    fs, at = place(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, put in its place when it is whole."""
    fs, at = place(spark, path)
    fs.mkdirs(at.getParent())
    staged = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}.new")
    fs.setWriteChecksum(False)  # people edit these files, which a checksum beside them would forbid
    stream = fs.create(staged, True)
    fs.setWriteChecksum(True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    fs.delete(at, False)
    fs.rename(staged, at)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file; None if there is none."""
    fs, at = place(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share; where the session names none, one of this machine if all tasks run on it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that the executors share")
        found = tempfile.mkdtemp(prefix="dialoom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Whether Spark deletes what a query has shuffled when the query ends, not when the driver's memory is next cleaned.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """For writes whose plan nobody runs again: what they shuffled is gone when they end."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder, so that all who read them read the same; Spark deletes them once nobody does."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession))
    return df.checkpoint()
