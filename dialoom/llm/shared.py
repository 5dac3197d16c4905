"""What the operators have in common: the shared folder, written tables, batches of bounded size."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Texts handled at once by a Python worker; a single longer text is handled alone.
SLICE_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Where the session names none, a folder of this machine is made, if all tasks run on it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that the executors share")
        found = tempfile.mkdtemp(prefix="dialoom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Scratch:
    """Written tables of one run. They live in the shared folder, so a lost executor loses none of them."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"

    def keep(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Write df and read it back, which cuts its lineage. by: a column to lay folders out by."""
        to = f"{self.root}/{name}"
        writer = df.write.mode("overwrite").option("compression", "zstd")
        (writer.partitionBy(by) if by else writer).parquet(to)
        return self.spark.read.schema(df.schema).parquet(to)

    def keep_bucketed(self, df: DataFrame, key: str, name: str) -> DataFrame:
        """Write df laid out by the hash of a key and read it back: what joins it by that key moves to it, and it is moved no more.

        The layout is only known through a table of the catalogue, which `forget` takes out again once all plans are made.
        """
        written = self.keep(df, f"{name}-loose")
        buckets, table = max(8, 2 * written.rdd.getNumPartitions()), f"{name}_{self.root.rsplit('-', 1)[1]}"
        written.repartition(buckets, key).write.option("compression", "zstd").option("path", f"{self.root}/{name}").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
        self.drop(f"{name}-loose")
        release(self.spark)
        return self.spark.table(table)

    def forget(self, name: str) -> None:
        """Take a bucketed table out of the catalogue. Its files stay until the results that read them are written."""
        self.spark.sql(f"DROP TABLE IF EXISTS {name}_{self.root.rsplit('-', 1)[1]}")

    def drop(self, *names: str) -> None:
        """Delete written tables that nothing reads any more."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)


    def clear(self, *but: str) -> None:
        """Delete all written tables but the named ones, which lazy results may still read."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            for entry in fs.listStatus(path):
                if entry.getPath().getName() not in but:
                    fs.delete(entry.getPath(), True)


def text_array(column: pa.Array) -> pa.LargeBinaryArray:
    """A string column as bytes with 64-bit offsets; null becomes empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    return column.fill_null("").cast(pa.large_binary())


def sliced(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into runs of rows whose texts are together about `most` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        yield batch.slice(start)


def map_arrow(df: DataFrame, f: Callable[[pa.RecordBatch], Iterator[dict] | dict | None], schema: str, text: str = "text", most: int = SLICE_BYTES) -> DataFrame:
    """mapInArrow over slices of bounded size; f gives columns by name."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    kind = _parse_datatype_string(schema)
    assert isinstance(kind, StructType)
    arrow = to_arrow_schema(kind)

    def run(batches):
        for batch in sliced(batches, text, most):
            found = f(batch)
            if found is not None:
                yield pa.RecordBatch.from_arrays([pa.array(found[x.name], x.type) for x in arrow], schema=arrow)

    return df.mapInArrow(run, kind)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps, which it does once the driver has collected its garbage."""
    import gc

    gc.collect()
    spark._jvm.System.gc()
