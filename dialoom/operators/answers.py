"""Answers of services that are written before anything is made of them, so that each request is sent once."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files
from .runs import cache_key

#: Requests of a task, about; what a lost task or a killed job sends again is at most what its open tasks had.
REQUESTS = 500
#: Tasks that requests go to at most, about: each writes a file, and tasks grow beyond REQUESTS rather than become more.
MOST_TASKS = 2000
#: Parts of a log that one is opened with; more are put together first.
MOST_PARTS = 200
#: Of answers and steps, which are as large as the texts.
CODEC = "zstd"
SCHEMA = "key string, text string, translation string, status string, attempts int, error string, run string"


class AnswerLog:
    """A table of answers by request. What asks it gets written rows, whatever its plan does with them.

    A request is a text, a service, its languages, and whether it is asked past the service's memory. Every task writes its answers
    and commits them when it ends (not when the job does), so a job that is killed leaves what its ended tasks were
    told. Answers that are there are not asked for again: those that succeeded ever, those that failed in this run. If a
    task ends twice its rows are there twice, and one of them counts.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path, self.run = spark, path or f"{files.scratch_dir(spark)}/answers-{uuid.uuid4().hex[:12]}", uuid.uuid4().hex
        if len(self.parts()) > MOST_PARTS:
            self.compact()

    def parts(self) -> list[str]:
        """Folders of answers, one for each time that something was asked."""
        return [x for x in files.names(self.spark, self.path) if not x.startswith(("_", "."))]

    def rows(self) -> DataFrame:
        """Every answer there is. Each part is a path of its own: Spark takes reads of one path for the same, however many files it had at the time."""
        parts = self.parts()
        return self.spark.read.schema(SCHEMA).parquet(*(f"{self.path}/{x}" for x in parts)) if parts else self.spark.range(0).select(F.from_json(F.lit(None).cast("string"), SCHEMA).alias("a")).select("a.*")

    def usable(self) -> DataFrame:
        """The answers that are not asked for again."""
        return self.rows().where((F.col("status") == "ok") | (F.col("run") == self.run))

    def step(self, df: DataFrame) -> str:
        to = f"{self.path}-steps/{uuid.uuid4().hex[:12]}"
        with files.shuffles_freed(self.spark):
            df.write.option("compression", CODEC).parquet(to)
        return to

    def keep(self, df: DataFrame) -> DataFrame:
        """Write a step of what is made of answers, and read it back; `end` deletes all of these."""
        return self.spark.read.schema(df.schema).parquet(self.step(df))

    @contextmanager
    def kept(self, df: DataFrame) -> Iterator[DataFrame]:
        """A step that is deleted after the block."""
        to = self.step(df)
        try:
            yield self.spark.read.schema(df.schema).parquet(to)
        finally:
            files.delete(self.spark, to)

    def end(self) -> None:
        """Delete the steps, once all results are written. The answers stay."""
        files.delete(self.spark, f"{self.path}-steps")

    def compact(self) -> None:
        """All parts as one, with the answers that succeeded once each. Ended half-way it leaves answers twice, which does no harm."""
        parts = self.parts()
        once = self.rows().where("status = 'ok'").dropDuplicates(["key"])
        once.write.option("compression", CODEC).parquet(f"{self.path}/all-{uuid.uuid4().hex[:12]}")
        for x in parts:
            files.delete(self.spark, f"{self.path}/{x}")

    def best(self, keys: DataFrame) -> DataFrame:
        """The answer that counts of each of these keys: one that succeeded, else the last one's failure in this run."""
        mine = self.usable().join(keys.select("key"), "key", "left_semi")
        order = F.struct(F.col("status") == "ok", F.col("attempts"), F.col("translation"))
        return mine.groupBy("key").agg(F.max_by(F.struct("text", "translation", "status", "attempts", "error"), order).alias("a")).select("key", "a.*")

    def unanswered(self, texts: DataFrame) -> DataFrame:
        """The rows whose key has no answer yet."""
        return texts.join(self.usable().select("key"), "key", "left_anti") if self.parts() else texts

    def send(self, texts: DataFrame, translator: str, source: str = "en", target: str = "fr", again: bool = False, **policy) -> None:
        """Ask for each distinct text of key, text, which are read twice: to count keys, and to move texts, once. All is written when this returns."""
        from .translate import translate_distinct

        if n := texts.select("key").distinct().count():
            sent = translate_distinct(texts.select("text"), translator, source, target, again=again, parts=-(-n // max(REQUESTS, n // MOST_TASKS)), **policy)
            rows = sent.select(self.key("text", translator, source, target, again).alias("key"), "text", "translation", "status", "attempts", "error", F.lit(self.run).alias("run"))
            with files.shuffles_freed(self.spark):
                # a task's files are in their place when it commits, not when the job does
                rows.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").option("compression", CODEC).parquet(f"{self.path}/{self.run}-{len(self.parts())}")

    @staticmethod
    def key(text: str, translator: str, source: str = "en", target: str = "fr", again: bool = False, **_) -> Column:
        """The key of a request for the column `text`."""
        return cache_key(F.col(text), translator, source, target, "again" if again else "")

    def ask(self, texts: DataFrame, translator: str, source: str = "en", target: str = "fr", again: bool = False, column: str = "text", **policy) -> DataFrame:
        """Each distinct text that is not null with its answer: text, translation, status, attempts, error. Sends what has no answer, and returns when all is written."""
        wanted = texts.select(F.col(column).alias("text")).where("text is not null").withColumn("key", self.key("text", translator, source, target, again))
        with self.kept(self.unanswered(wanted).select("key", "text").distinct()) as todo:
            self.send(todo, translator, source, target, again, **policy)
        # the texts come from the log, so that only keys are shuffled here
        return self.best(wanted.select("key").distinct()).select("text", "translation", "status", "attempts", "error")

    def told(self, places: DataFrame) -> DataFrame:
        """Places (key, and what says where its text stands) with said (the translation; the text if it failed), status, attempts, error. An answer is moved once."""
        mine = self.usable().select("key", F.coalesce("translation", "text").alias("said"), "status", "attempts", "error").repartition("key")
        order = F.struct(F.col("status") == "ok", F.col("attempts"), F.col("said"))
        once = mine.join(places.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.max_by(F.struct("said", "status", "attempts", "error"), order).alias("a"))
        return places.join(once.select("key", "a.*"), "key")
