"""Judging of translations: cross joins of tasks, prompts, calls, and resumable runs."""

from __future__ import annotations

import inspect
from collections.abc import Callable
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..functions.scoring import parsed_score
from .calls import replies, shared_limit, spread
from .incremental import latest, pending
from .runs import RetryPolicy

#: prompt -> reply.
JUDGES: dict[str, Callable[[str], str]] = {"length": lambda prompt: f'{{"score": {len(prompt) % 101}, "comment": "by length"}}'}


#: What a call leaves beside its row.
CALL = {"reply": pa.string(), "error": pa.string(), "attempts": pa.int64(), "rate_limit_waits": pa.int64(), "rate_limit_wait_seconds": pa.float64()}
#: Rows of a list that is broadcast to be crossed with samples.
SHORT_LIST = 10_000


def tasks(samples: DataFrame, others: DataFrame) -> DataFrame:
    """Every sample with every field pair, or every model. The other side is a short list, which is checked."""
    if others.limit(SHORT_LIST + 1).count() > SHORT_LIST:
        raise ValueError(f"more than {SHORT_LIST} field pairs or models")
    return samples.crossJoin(F.broadcast(others))


def with_prompt(rows: DataFrame, template: str, names: dict[str, str]) -> DataFrame:
    prompt = F.lit(template)
    for name, column in names.items():
        prompt = F.replace(prompt, F.lit("{" + name + "}"), F.coalesce(F.col(column).cast("string"), F.lit("")))
    return rows.withColumn("prompt", prompt)


def judged(rows: DataFrame, judge: str, retries: int = 0, sleep: float = 0.0, per_minute: int = 0, concurrency: int = 0, max_tokens: int = 0) -> DataFrame:
    """Rows with reply, score, comment, status, attempts and waits for the rate limit; a failed call is a row with status error. per_minute, concurrency: of all tasks together; max_tokens: of a reply, told to judges that take it."""
    call, policy, limit = JUDGES[judge], RetryPolicy(retries, sleep), shared_limit(rows.sparkSession, per_minute, concurrency)

    if max_tokens > 0 and "max_tokens" in inspect.signature(call).parameters:
        call = partial(call, max_tokens=max_tokens)

    def run(batches):
        for batch in batches:
            out = [(r.value, r.error, r.attempts, r.waits, r.seconds) for r in replies(batch.column("prompt").to_pylist(), call, policy, limit)]
            columns = zip(*out, strict=True) if out else [[]] * len(CALL)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, t) for c, t in zip(columns, CALL.values(), strict=True))], names=[*batch.schema.names, *CALL])

    schema = StructType([*rows.schema.fields, StructField("reply", StringType()), StructField("error", StringType()), StructField("attempts", LongType()), StructField("rate_limit_waits", LongType()), StructField("rate_limit_wait_seconds", DoubleType())])
    rows = rows.repartition(spread(rows.sparkSession, limit)) if concurrency > 0 else rows
    done = rows.mapInArrow(run, schema).withColumn("parsed", parsed_score(F.col("reply")))
    status = F.when(F.col("error") != "", "error").otherwise(F.col("parsed.parse_status"))
    return done.select(*rows.columns, "reply", "error", "parsed.score", "parsed.comment", status.alias("status"), "attempts", "rate_limit_waits", "rate_limit_wait_seconds")


def resumed(all_tasks: DataFrame, records: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Tasks whose latest record is not ok."""
    return pending(all_tasks, latest(records, keys, order).where("trim(status) = 'ok'"), keys)
