"""Latest records, attempts and what is still to do."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAILED = ["error", "exception", "failed"]


def latest(records: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last record of each key. A maximum by group, so it combines before the shuffle and no key is sorted."""
    rest = [c for c in records.columns if c not in keys]
    found = records.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return found.select(*keys, "r.*")


def succeeded(records: DataFrame, fields: list[str], status: str = "status") -> DataFrame:
    there = F.lit(True)
    for f in fields:
        there = there & F.col(f).isNotNull()
    return records.where(there & ~F.lower(F.trim(F.coalesce(status, F.lit("ok")))).isin(FAILED))


def pending(tasks: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return tasks.join(done.select(*keys), keys, "left_anti")


def next_attempt(records: DataFrame, candidate: str = "candidate", attempt: str = "attempt") -> DataFrame:
    return records.groupBy(candidate).agg((F.coalesce(F.max(attempt), F.lit(0)) + 1).alias("next_attempt"))


def compacted(records: DataFrame, candidate: str = "candidate", attempt: str = "attempt", kind: str = "record_type") -> DataFrame:
    """Rows of each candidate's latest attempt; candidates without a status row go, rows without a candidate stay."""
    last = records.where(F.col(kind) == "status").groupBy(candidate).agg(F.max(attempt).alias(attempt))
    return records.join(last, [candidate, attempt], "left_semi").unionByName(records.where(F.col(candidate).isNull()))
