"""Runs that can be taken up again: batches of rows, attempts, records appended and compacted, gates before the last write."""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .incremental import compacted, latest, succeeded


@dataclass(frozen=True)
class RetryPolicy:
    """Calls again after a failure: waits that double, with a random part, up to eight times the first."""

    retries: int = 2
    sleep: float = 0.0

    def wait(self, attempt: int, draw: random.Random) -> float:
        if self.sleep <= 0:
            return 0.0
        return min(8 * self.sleep, self.sleep * 2 ** (attempt - 1) + draw.uniform(0, self.sleep))

    def call(self, operation: Callable[[], object], sleep: Callable[[float], None] = time.sleep) -> tuple[object, int, str]:
        """(value or None, attempts, error)."""
        draw, error = random.Random(), ""
        for attempt in range(1, self.retries + 2):
            try:
                return operation(), attempt, ""
            except Exception as e:  # whatever a service raises is the row's error
                error = f"{type(e).__name__}: {str(e)[:300]}"
                if attempt <= self.retries:
                    sleep(self.wait(attempt, draw))
        return None, self.retries + 1, error


class RateLimit:
    """So many calls in 60 seconds, a fixed share of them for each of `tasks`, where nothing can be asked of the driver (see calls.shared_limit); counts the waits."""

    def __init__(self, per_minute: int, tasks: int = 1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        if per_minute > 0 and tasks < 1:
            raise ValueError("a limit is shared by a known number of tasks")
        self.most = max(1, per_minute // tasks) if per_minute > 0 else 0
        self.clock, self.sleep = clock, sleep
        self.times: list[float] = []
        self.waits, self.seconds = 0, 0.0

    def enter(self) -> None:
        if not self.most:
            return
        now = self.clock()
        self.times = [t for t in self.times if t > now - 60]
        if len(self.times) >= self.most:
            pause = self.times[-self.most] + 60 - now
            if pause > 0.01:
                self.waits, self.seconds = self.waits + 1, self.seconds + pause
                self.sleep(pause)
        self.times.append(self.clock())


def cache_key(text: Column, provider: str, source: str, target: str, identity: str = "") -> Column:
    """What an answer is remembered by."""
    return F.sha2(F.concat_ws("\u0000", F.lit(provider), F.lit(source), F.lit(target), F.lit(identity), F.coalesce(text, F.lit(""))), 256)


def with_cache(texts: DataFrame, cache: DataFrame, translate: Callable[[DataFrame], DataFrame], provider: str, source: str, target: str) -> tuple[DataFrame, DataFrame]:
    """(all answers, the new ones to append to the cache): only texts that the cache (key, translation) has not are sent."""
    keyed = texts.select("text").distinct().withColumn("key", cache_key(F.col("text"), provider, source, target))
    known = keyed.join(cache.select("key", "translation"), "key")
    new = translate(keyed.join(cache.select("key"), "key", "left_anti").select("text")).withColumn("key", cache_key(F.col("text"), provider, source, target))
    fresh = new.where("translation is not null").select("key", "text", "translation")
    return known.select("key", "text", "translation").unionByName(new.select("key", "text", "translation")), fresh


def row_batches(counts: dict[str, int], size: int, done: DataFrame | None = None) -> list[tuple[str, int, int]]:
    """(split, first row, end) of every batch that is not done. done: split, row_idx of rows that are."""
    finished: dict[tuple[str, int], int] = {}
    if done is not None:
        block = F.floor(F.col("row_idx") / size).cast("long")
        finished = {(r.split, r.block): r.n for r in done.select("split", "row_idx").distinct().groupBy("split", block.alias("block")).agg(F.count("*").alias("n")).collect()}
    out = []
    for split, n in counts.items():
        for start in range(0, n, size):
            end = min(n, start + size)
            if finished.get((split, start // size), 0) < end - start:
                out.append((split, start, end))
    return out


def restored(records: DataFrame, fields: list[str], limit: int = 0) -> DataFrame:
    """The last record of each row that succeeded; rows beyond a limit and failed ones are to be done (again)."""
    last = latest(records, ["split", "row_idx"], ["attempt"]) if "attempt" in records.columns else records
    good = succeeded(last, fields)
    return good.where(F.col("row_idx") < limit) if limit > 0 else good


def materialised(rows: DataFrame, records: DataFrame, targets: list[str], drop: tuple[str, ...] = (), limit: int = 0) -> DataFrame:
    """Rows with their translated targets. A row without a record is an error, so nothing is written that has a gap."""
    rows = rows.where(F.col("row_idx") < limit) if limit > 0 else rows
    missing = rows.select("split", "row_idx").join(records.select("split", "row_idx"), ["split", "row_idx"], "left_anti")
    if gap := missing.groupBy("split").agg(F.count("*").alias("n")).orderBy("split").collect():
        raise ValueError("rows without a record: " + ", ".join(f"{r.split} {r.n}" for r in gap))
    kept = rows.drop(*targets, *drop)
    return kept.join(records.select("split", "row_idx", *targets), ["split", "row_idx"])


def failed_splits(records: DataFrame) -> DataFrame:
    """Splits with an error in this run."""
    return records.where(F.coalesce("error", F.lit("")) != "").select("split").distinct()


def gated(records: DataFrame, allow_errors: bool) -> list[str]:
    """The failed splits; an error if there are any and they are not allowed, before the last write, with records kept."""
    found = sorted(r.split for r in failed_splits(records).collect())
    if found and not allow_errors:
        raise RuntimeError(f"splits with errors: {', '.join(found)}")
    return found


def swap(spark, df: DataFrame, path: str) -> None:
    """Write a table beside an old one, then put it in its place; a reader finds the old or the new one whole."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path
    staged, old = f"{path}.{uuid.uuid4().hex[:8]}", f"{path}.old"
    df.write.parquet(staged)
    fs = at(path).getFileSystem(conf)
    fs.delete(at(old), True)
    if fs.exists(at(path)):
        fs.rename(at(path), at(old))
    fs.rename(at(staged), at(path))
    fs.delete(at(old), True)


def append_and_compact(spark, new: DataFrame, path: str, compact: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Records with the new ones added, and then only those that count."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(conf).exists(at):
        new.write.mode("append").parquet(path)
    else:
        new.write.parquet(path)
    swap(spark, compact(spark.read.parquet(path)), path)
    return spark.read.parquet(path)


def run_records(spark, tasks: DataFrame, path: str, keys: list[str], process: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Process the tasks without an ok record, append what comes of them, keep the last record of each key."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    todo, attempt = tasks, F.lit(1)
    if at.getFileSystem(conf).exists(at):
        done = spark.read.parquet(path)
        todo = tasks.join(done.where("trim(status) = 'ok'").select(*keys), keys, "left_anti")
        attempt = F.lit((done.agg(F.max("_run")).first()[0] or 0) + 1)
    found = process(todo).withColumn("_run", attempt)
    return append_and_compact(spark, found, path, lambda df: latest(df, keys, ["_run"]))


def run_candidates(spark, candidates: dict[str, str], path: str, process: Callable[[str, str], tuple[dict, DataFrame | None]]) -> dict[str, str]:
    """Every candidate that is not ok yet, one after the other; a failure is a status, and the next one still runs. Gives status by candidate.

    process gives (summary, details). Rows have candidate, attempt, status, record_type, error, summary (JSON), detail (JSON).
    """
    import json

    schema = "candidate string, attempt int, status string, record_type string, error string, summary string, detail string"
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    before = spark.read.parquet(path) if at.getFileSystem(conf).exists(at) else spark.createDataFrame([], schema)
    last = {r.candidate: (r.attempt, r.status) for r in before.where("record_type = 'status'").groupBy("candidate").agg(F.max("attempt").alias("attempt"), F.max_by("status", "attempt").alias("status")).collect()}
    out = {}
    for name, where in candidates.items():
        attempt, status = last.get(name, (0, ""))
        if status == "ok":
            out[name] = "ok"
            continue
        attempt += 1
        try:
            summary, details = process(name, where)
            error, status = "", "ok"
        except Exception as e:  # a candidate's failure is its status
            summary, details, error, status = {}, None, f"{type(e).__name__}: {str(e)[:300]}", "error"
        rows = spark.createDataFrame([(name, attempt, status, "status", error, json.dumps(summary, ensure_ascii=False), None)], schema)
        if details is not None:
            rows = rows.unionByName(details.select(F.lit(name).alias("candidate"), F.lit(attempt).alias("attempt"), F.lit("ok").alias("status"), F.lit("detail").alias("record_type"), F.lit("").alias("error"), F.lit(None).cast("string").alias("summary"), F.to_json(F.struct(*details.columns)).alias("detail")))
        append_and_compact(spark, rows, path, compacted)
        out[name] = status
    return out


def with_defaults(rows: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Columns that are missing, and nulls of those that are there, as given constants."""
    return rows.withColumns({name: F.coalesce(F.col(name), F.lit(value)) if name in rows.columns else F.lit(value) for name, value in defaults.items()})
