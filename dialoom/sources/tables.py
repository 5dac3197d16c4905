"""Reading and writing of tables, records and side files."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.runs import RetryPolicy
from . import files


def read_source(spark: SparkSession, kind: str, path: str | None = None, remote: str | None = None, prefer_local: bool = False, max_rows: int = 0) -> DataFrame:
    """A dataset by policy: `disk`, `remote`, or `auto` (remote where one is named, unless local is preferred). A remote name is one that is registered, or a Parquet path. A path that is not there is an error before any job."""
    if kind not in ("auto", "remote", "disk"):
        raise ValueError(f"unknown kind {kind!r}")
    use = remote if kind == "remote" or kind == "auto" and remote and not (prefer_local and path) else path
    if not use:
        raise FileNotFoundError(f"no path for a source of kind {kind!r}")
    if use in REMOTES and use == remote:
        df = REMOTES[use](spark)
    else:
        at = spark._jvm.org.apache.hadoop.fs.Path(use)
        if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            raise FileNotFoundError(use)
        df = spark.read.parquet(use)
    return df.where(F.col("row_idx") < max_rows) if max_rows > 0 else df


def read_text(path: str) -> str:
    """A prompt or another small file."""
    return Path(path).read_text(encoding="utf-8")


def with_passthrough(translated: DataFrame, others: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """With splits of other datasets (dataset, its split, the name here), which take the place of one of that name; columns are those of all."""
    out = translated
    for other, source, name in others:
        found = other.where(F.col("split") == source)
        if found.isEmpty():
            raise ValueError(f"no split {source!r} to pass through")
        out = out.where(F.col("split") != name).unionByName(found.withColumn("split", F.lit(name)), allowMissingColumns=True)
    return out


def limited(source: DataFrame, target: DataFrame, max_rows: int = 0) -> tuple[DataFrame, DataFrame]:
    """The first rows of every split of both, so many at most."""
    if max_rows <= 0:
        return source, target
    return source.where(F.col("row_idx") < max_rows), target.where(F.col("row_idx") < max_rows)


def read_splits(spark: SparkSession, files: dict[str, list[str]], columns: list[str] | None = None) -> DataFrame:
    """Parquet files by split, with a split column; only the named columns are read."""
    parts = [(df.select(*dict.fromkeys(columns)) if columns else df).withColumn("split", F.lit(split)) for split, paths in files.items() for df in [spark.read.parquet(*paths)]]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def read_records(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines; a missing file is an empty table."""
    conf = spark._jsc.hadoopConfiguration()
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return spark.read.schema(schema).json(path) if at.getFileSystem(conf).exists(at) else spark.createDataFrame([], schema)


def read_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines with their place, in the column `line`: of two records of a key the later line is the greater. A missing file is an empty table."""
    conf = spark._jsc.hadoopConfiguration()
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    kind = schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema
    if not at.getFileSystem(conf).exists(at):
        return spark.createDataFrame([], kind).withColumn("line", F.lit(None).cast("struct<file:string,block:bigint,row:bigint>"))
    # blocks of a file are in order, and so are the lines that one task reads of a block
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    rows = spark.read.text(path).select("value", place.alias("line")).where("trim(value) <> ''")
    return rows.select(F.from_json("value", kind).alias("r"), "line").select("r.*", "line")


#: name -> (offset, length) -> rows of a dataset that is served page by page, and name -> rows in all.
PAGES: dict[str, tuple[Callable[[int, int], list[dict]], Callable[[], int]]] = {}
#: Partitions of a paged scan, at most.
MOST_PARTITIONS = 10_000
#: name -> a dataset that some service loads.
REMOTES: dict[str, Callable[[SparkSession], DataFrame]] = {}


def register_pages(name: str, fetch: Callable[[int, int], list[dict]], total: Callable[[], int]) -> None:
    PAGES[name] = (fetch, total)


def register_remote(name: str, load: Callable[[SparkSession], DataFrame]) -> None:
    REMOTES[name] = load


def paged_source(name: str) -> type[DataSource]:
    """The data source `pages_NAME` of a registered paged dataset; a page range is a partition, and a page that fails is asked for again.

    Options: split, size (rows of a page), pages (of a partition), max_rows, retries, sleep. The class holds how pages are
    fetched, as Spark plans its reads in another process.
    """
    found = PAGES[name]

    class Pages(DataSource):
        @classmethod
        def name(cls) -> str:
            return f"pages_{name}"

        def reader(self, schema: StructType) -> DataSourceReader:
            return PagedReader(schema, found, {k.lower(): v for k, v in self.options.items()})

    return Pages


class PagedReader(DataSourceReader):
    def __init__(self, schema: StructType, pages: tuple[Callable[[int, int], list[dict]], Callable[[], int]], options: dict[str, str]):
        self.fetch, total = pages
        most = int(options.get("max_rows", 0))
        self.schema, self.split = schema, options.get("split", "train")
        self.size, self.pages = int(options.get("size", 100)), int(options.get("pages", 10))
        self.n = min(total(), most) if most > 0 else total()
        self.policy = RetryPolicy(int(options.get("retries", 3)), float(options.get("sleep", 1.0)))

    def partitions(self) -> list[InputPartition]:
        step = self.size * max(self.pages, -(-self.n // (self.size * MOST_PARTITIONS)))
        return [InputPartition(start) for start in range(0, max(self.n, 1), step)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(self.schema)
        step = self.size * max(self.pages, -(-self.n // (self.size * MOST_PARTITIONS)))
        for start in range(partition.value, min(partition.value + step, self.n), self.size):
            wanted = min(self.size, self.n - start)
            rows, attempts, error = self.policy.call(lambda start=start, wanted=wanted: self.fetch(start, wanted))
            if rows is None:
                raise OSError(f"rows {start} to {start + wanted}: {error} ({attempts} attempts)")
            if len(rows) != wanted:
                raise OSError(f"rows {start} to {start + wanted}: {len(rows)} came")
            at = {"split": [self.split] * wanted, "row_idx": list(range(start, start + wanted))}
            columns = [at[f.name] if f.name in at else [r.get(f.name) for r in rows] for f in arrow]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)


def read_pages(spark: SparkSession, name: str, schema: str, split: str = "train", size: int = 100, max_rows: int = 0, **options) -> DataFrame:
    """A paged dataset with split and row_idx, by a data source of its own: only the columns of `schema` are taken out of a page, and a lost task asks for its own pages again."""
    spark.dataSource.register(paged_source(name))
    kind = StructType([StructField("split", StringType()), StructField("row_idx", LongType()), *spark.createDataFrame([], schema).schema.fields])
    return spark.read.format(f"pages_{name}").schema(kind).options(split=split, size=size, max_rows=max_rows, **options).load()


def cached_columns(spark: SparkSession, files: list[str], columns: list[str], cache: str, retries: int = 3) -> DataFrame:
    """The named columns of Parquet files, each once, from a copy of them alone that is made when they are first asked for."""
    import hashlib
    import uuid

    wanted = list(dict.fromkeys(columns))
    to = f"{cache}/{hashlib.sha256(json.dumps([files, sorted(wanted)]).encode()).hexdigest()[:20]}"
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path
    fs = at(to).getFileSystem(conf)
    for attempt in range(retries + 1):
        if fs.exists(at(f"{to}/_SUCCESS")):
            break
        staged = f"{to}.{uuid.uuid4().hex[:8]}"
        try:
            spark.read.parquet(*files).select(*wanted).write.parquet(staged)
            fs.delete(at(to), True)
            fs.rename(at(staged), at(to))
        except Exception:
            fs.delete(at(staged), True)
            if attempt == retries:
                raise
    return spark.read.parquet(to).select(*wanted)


def numbered_files(df: DataFrame) -> DataFrame:
    """A Parquet read with row_idx: the place of a row in its file, after the rows of the files before. Files are counted from their rows' own numbers, so nothing is sorted or moved."""
    named = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = named.groupBy("_file").agg((F.max("_row") + 1).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a file
    starts = sizes.select("_file", before.alias("_start"))
    return named.join(F.broadcast(starts), "_file").withColumn("row_idx", F.col("_start") + F.col("_row")).drop("_file", "_row", "_start")


def read_split(spark: SparkSession, root: str, repo: str, config: str, split: str, columns: list[str]) -> DataFrame:
    """The named columns of a split, with split and row_idx: a registered dataset, or the Parquet files of root/repo/config/split."""
    if repo in REMOTES:
        return REMOTES[repo](spark).where(F.col("split") == split).select("split", "row_idx", *dict.fromkeys(columns))
    at = f"{root}/{repo}/{config}/{split}"
    if not any(x.endswith(".parquet") for x in files.names(spark, at)):
        raise FileNotFoundError(f"no parquet files for {repo} {config}/{split}")
    df = spark.read.parquet(at)
    if missing := sorted(set(columns) - set(df.columns)):
        raise ValueError(f"{repo} {config}/{split} has no column {', '.join(missing)}")
    df = df if "row_idx" in df.columns else numbered_files(df)
    return df.select(F.lit(split).alias("split"), "row_idx", *dict.fromkeys(columns))


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(path)


def fingerprints(df: DataFrame) -> DataFrame:
    """By split a number that any change of content changes, and the rows. Order-free, in one partial aggregation.

    Hashes are added, not only combined bit by bit, so that equal rows do not cancel out.
    """
    columns = [c for c in sorted(df.columns) if c != "split"]
    h = F.xxhash64(*columns)
    total = F.sum(h.cast("decimal(20,0)"))
    return df.groupBy("split").agg(F.count("*").alias("rows"), F.sha2(F.concat_ws(",", total.cast("string"), F.bit_xor(h).cast("string"), F.count("*").cast("string")), 256).alias("fingerprint"))


def renamed_splits(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    name = F.col("split")
    for source, target in mapping.items():
        name = F.when(F.col("split") == source, target).otherwise(name)
    return df.withColumn("split", name)


def write_splits(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def write_records(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def write_report(report: dict, path: str) -> None:
    """A small JSON file, on the file system that its path names."""
    files.write_text(SparkSession.active(), path, json.dumps(report, ensure_ascii=False, indent=2))


def write_manifest(found: dict, folder: str) -> None:
    write_report(found, f"{folder}/manifest.json")


def read_manifest(folder: str) -> dict | None:
    """The side file of a folder; None where there is none. One that is no object, or of another version, is an error."""
    at = f"{folder}/manifest.json"
    text = files.read_text(SparkSession.active(), at)
    if text is None:
        return None
    found = json.loads(text)
    if not isinstance(found, dict) or found.get("schema_version") != 1:
        raise ValueError(f"{at}: not a manifest of version 1")
    return found


def manifest(kind: str, dataset: str, run: str, lang: str, marks: dict) -> dict:
    return {"schema_version": 1, "kind": kind, "dataset": dataset, "run": run, "lang": lang, "created_at": datetime.now(timezone.utc).isoformat(), "fingerprints": marks}


def export_splits(df: DataFrame, path: str) -> dict[str, int]:
    """One Parquet file per split, in row order, named as hubs expect; gives the rows of each. The folder is emptied first.

    A split of an export is one file by contract, so it is written by one task; splits beyond that are for write_splits.
    """
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path_of = jvm.org.apache.hadoop.fs.Path
    fs = path_of(path).getFileSystem(conf)
    fs.delete(path_of(path), True)
    rows = {r.split: r.n for r in df.groupBy("split").agg(F.count("*").alias("n")).collect()}
    for split in rows:
        staged = f"{path}/_{split}"
        df.where(F.col("split") == split).repartition(1).sortWithinPartitions("row_idx").drop("split", "row_idx").write.parquet(staged)
        (part,) = [f.getPath() for f in fs.listStatus(path_of(staged)) if f.getPath().getName().startswith("part-")]
        fs.rename(part, path_of(f"{path}/{split}-00000-of-00001.parquet"))
        fs.delete(path_of(staged), True)
    return rows


def export_all(datasets: dict[str, DataFrame], export: dict, folder: str, transform) -> dict[str, dict[str, int]]:
    """Every config of an export, reshaped and written split by split, with the head of its README; rows by config and split."""
    entries = [export] if export.get("layout", "single_config") == "single_config" else export["configs"]
    out, splits = {}, {}
    for entry in entries:
        name = entry.get("config_name", "default")
        df = transform(datasets[name], [(t["name"], {k: v for k, v in t.items() if k != "name"}) for t in entry.get("transforms", ())])
        if wanted := entry.get("splits"):
            df = renamed_splits(df.where(F.col("split").isin(list(wanted))), wanted if isinstance(wanted, dict) else {})
        out[name] = export_splits(df, f"{folder}/{name}")
        splits[name] = sorted(out[name])
    files.write_text(SparkSession.active(), f"{folder}/README.md", front_matter(splits))
    return out


def push_commands(repo: str, folder: str, yes: bool) -> list[list[str]]:
    """What would put an export on a hub. Nothing is run here; without a clear yes there is not even that."""
    if not yes:
        raise PermissionError("pushing needs a yes")
    return [["hf", "repos", "create", repo, "--type", "dataset", "--exist-ok"], ["hf", "upload", repo, folder, ".", "--type", "dataset"]]


def front_matter(configs: dict[str, list[str]]) -> str:
    """The head of an export's README: for every config the files of its splits."""
    lines = ["---", "configs:"]
    for name, splits in configs.items():
        lines += [f"- config_name: {name}", "  data_files:"]
        for split in splits:
            lines += [f"  - split: {split}", f"    path: {name}/{split}-*.parquet"]
    return "\n".join([*lines, "---", ""])
