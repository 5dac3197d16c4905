"""Records of a long run by ranges of rows, each there whole or not at all, so that a run that ended anywhere goes on where it was."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import reduce
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files
from .incremental import latest

#: Ranges of a job, and of a whole run, about: ranges grow beyond what is asked for rather than become more.
AT_ONCE, MOST_RANGES = 64, 20_000

Range = tuple[str, int, int]  # split, first row, end


class RangeLog:
    """A table of records in folders of one range each: `range=split~first~end~attempt`.

    A job writes some ranges beside the table; then each is moved to its place by one rename, which is its commit. Rows of ranges
    that are there are not read again, as what is left is asked of the source by (split, row_idx), which reaches its scan.
    Rows that failed are done again in an attempt of their own; the last attempt of a row counts.
    """

    def __init__(self, spark: SparkSession, path: str, size: int = 1000):
        self.spark, self.path, self.size = spark, path.rstrip("/"), max(1, size)

    def committed(self) -> list[tuple[str, int, int, int]]:
        """(split, first, end, attempt) of each range that is there; rows done again have no bounds (-1)."""
        found = []
        for name in files.names(self.spark, self.path):
            if name.startswith("range="):
                split, first, end, attempt = name[6:].rsplit("~", 3)
                found.append((unquote(split), int(first), int(end), int(attempt)))
        return found

    def pending(self, counts: dict[str, int]) -> Iterator[Range]:
        """What is left of rows 0..n-1 of each split, in ranges of `size` rows or more."""
        size = max(self.size, -(-sum(counts.values()) // MOST_RANGES))
        done: dict[str, list[tuple[int, int]]] = {}
        for split, first, end, _ in self.committed():
            if first >= 0:
                done.setdefault(split, []).append((first, end))
        for split, n in sorted(counts.items()):
            at = 0
            for first, end in [*sorted(done.get(split, [])), (n, n)]:
                for start in range(at, min(first, n), size):
                    yield split, start, min(start + size, first, n)
                at = max(at, end)

    def records(self) -> DataFrame | None:
        """The record that counts of every row; None before the first one."""
        if not self.committed():
            return None
        every = self.spark.read.option("basePath", self.path).parquet(self.path)
        return latest(every.withColumn("_attempt", F.element_at(F.split("range", "~"), -1).cast("int")), ["split", "row_idx"], ["_attempt"]).drop("_attempt", "range")

    def attempt(self) -> int:
        return max((a for *_, a in self.committed()), default=0) + 1

    def commit(self, staged: str, split: str, first: int, end: int, attempt: int) -> None:
        name = f"{quote(split, safe='')}~{first}~{end}~{attempt}"
        if files.exists(self.spark, staged):
            files.move(self.spark, staged, f"{self.path}/range={name}")
        else:  # a range without rows
            files.make_folder(self.spark, f"{self.path}/range={name}")

    def run(self, rows: DataFrame, process: Callable[[DataFrame], DataFrame], failed: str = "status <> 'ok'", ended: Callable[[], None] = lambda: None) -> None:
        """Process rows (split, row_idx from 0) that have no record, then those whose record failed in an earlier run. ended: after each job."""
        counts = {r.split: r.n for r in rows.groupBy("split").agg((F.max("row_idx") + 1).alias("n")).collect()}
        before, attempt = self.records(), self.attempt()
        left = list(self.pending(counts))
        step = max(AT_ONCE, -(-len(left) // 100))
        files.make_folder(self.spark, self.path)
        for at in range(0, len(left), step):
            self.write(rows, left[at : at + step], process, attempt)
            ended()
        if before is not None and not before.where(failed).isEmpty():
            again = rows.join(before.where(failed).select("split", "row_idx"), ["split", "row_idx"], "left_semi")
            staged = f"{self.path}-{uuid.uuid4().hex[:12]}"
            process(again).write.parquet(staged)
            self.commit(staged, "", -1, -1, attempt)
            ended()

    def write(self, rows: DataFrame, ranges: list[Range], process: Callable[[DataFrame], DataFrame], attempt: int) -> None:
        """One job for some ranges of a split each, then their commits."""
        by_split: dict[str, list[tuple[int, int]]] = {}
        for split, first, end in ranges:
            spans = by_split.setdefault(split, [])
            if spans and spans[-1][1] == first:
                spans[-1] = (spans[-1][0], end)
            else:
                spans.append((first, end))
        inside = lambda split, spans: (F.col("split") == split) & reduce(lambda a, b: a | b, ((F.col("row_idx") >= first) & (F.col("row_idx") < end) for first, end in spans))
        mine = rows.where(reduce(lambda a, b: a | b, (inside(split, spans) for split, spans in by_split.items())))
        # the number of a row's range among these, by division where ranges of one length follow each other: no row is held against all
        runs: list[list] = []  # split, first row, end, rows of a range, number of its first range
        for i, (split, first, end) in enumerate(ranges):
            last = runs[-1] if runs else None
            if last and last[0] == split and last[2] == first and (first - last[1]) % last[3] == 0 and end - first <= last[3]:
                last[2] = end
            else:
                runs.append([split, first, end, max(1, end - first), i])
        number = F.lit(None).cast("int")
        for split, first, end, size, i in reversed(runs):
            here = (F.col("split") == split) & (F.col("row_idx") >= first) & (F.col("row_idx") < end)
            number = F.when(here, (F.lit(i) + F.floor((F.col("row_idx") - first) / size)).cast("int")).otherwise(number)
        staged = f"{self.path}-{uuid.uuid4().hex[:12]}"
        process(mine).withColumn("_range", number).repartition(max(1, min(len(ranges), 200)), "_range").write.partitionBy("_range").parquet(staged)
        for i, (split, first, end) in enumerate(ranges):
            self.commit(f"{staged}/_range={i}", split, first, end, attempt)
        files.delete(self.spark, staged)
