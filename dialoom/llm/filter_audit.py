"""Interaction of document filters: what each removes, alone and in every order, with duplicates found by a range sort."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable
from dataclasses import dataclass
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, sliced, text_array

#: Letter of the filter for repeated texts, which no row can decide by itself.
REPEATED = "E"


@dataclass(frozen=True)
class Limits:
    """What a text must keep to: words at least, distinct words in a hundred at least, capital letters in a hundred characters at most, no such symbol."""

    words: int = 200
    distinct: int = 50
    capitals: int = 2
    symbols: str = "#$%&*|"

    def checks(self) -> dict[str, Callable[[bytes, list[bytes]], bool]]:
        """Letter -> whether a text (as bytes, and its words) fails."""
        small = bytes(i for i in range(256) if not 65 <= i <= 90)
        starts = bytes(i for i in range(128, 192))  # bytes that begin no code point
        symbols = re.compile(b"[" + re.escape(self.symbols.encode()) + b"]") if self.symbols else None
        return {
            "A": lambda text, words: len(words) < self.words,
            "B": lambda text, words: 100 * len(set(words)) < self.distinct * len(words),
            "C": lambda text, words: 100 * len(text.translate(None, small)) > self.capitals * len(text.translate(None, starts)),
            "D": lambda text, words: symbols is not None and symbols.search(text) is not None,
        }


FACTS = "doc_id long, part string, mask int, edge int, digest binary"
NONE, HEAD = 0, 1


def failures(docs: DataFrame, limits: Limits, scratch: Scratch, doc_id: str, text: str, part: str) -> DataFrame:
    """Rows of doc_id, part, mask: bit 0 for the first filter (A) to bit 4 for repeated texts (E).

    Texts move once, to a range sort by fingerprint, text and doc_id, whose ranges are cut by fingerprint, doc_id and row, so
    any number of equal texts spreads over as many tasks as its size needs. In a range a row looks at its predecessor: the
    first row of a run of equal texts has the least doc_id of the range. The first and last fingerprint of each range may
    go on in another one; the texts under them (one each, unless fingerprints collide) are listed by SHA-256 with their
    least doc_id, and that list, of a few rows for each range, settles the rows at the edges.
    """
    spark, checks = docs.sparkSession, limits.checks()
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.xxhash64(body).alias("print"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * rows.rdd.getNumPartitions())
    id_last = F.col("doc_id").asc_nulls_last()
    ranged = rows.repartitionByRange(parts, F.col("print"), id_last, F.col("row")).sortWithinPartitions(F.col("print"), F.col("text"), id_last)

    def judged(batches):
        head: int | None = None  # the first fingerprint of the range
        last: tuple[int, bytes] | None = None  # the run at the last row
        least: int | None = None
        edge: dict[bytes, int | None] = {}  # texts of the fingerprint at the last row, with their least doc_id
        for batch in sliced(batches, "text"):
            out: dict[str, list] = {"doc_id": [], "part": batch.column("part").to_pylist(), "mask": [], "edge": [], "digest": []}
            prints, ids = batch.column("print").to_pylist(), batch.column("doc_id").to_pylist()
            for fingerprint, key, data in zip(prints, ids, text_array(batch.column("text")).to_pylist(), strict=True):
                if head is None:
                    head = fingerprint
                if last is None or last[0] != fingerprint:
                    edge = {}
                if last is None or last != (fingerprint, data):
                    last, least = (fingerprint, data), key  # ids come in order, nulls last
                    words = data.split()  # at the bytes 20, 09 to 0D
                    mask = sum(1 << i for i, fails in enumerate(checks.values()) if fails(data, words))
                    digest = hashlib.sha256(data).digest()
                    edge[digest] = least
                repeated = key is not None and least is not None and least < key
                out["doc_id"].append(key)
                out["mask"].append(mask | repeated << len(checks))
                out["edge"].append(HEAD if fingerprint == head else NONE)
                out["digest"].append(digest if fingerprint == head else None)
            yield pa.RecordBatch.from_arrays([pa.array(out[f], t) for f, t in zip(out, (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=list(out))
        # the last fingerprint may go on in the next range, which asks for the least doc_id of its texts
        if edge:
            n = len(edge)
            yield pa.RecordBatch.from_arrays([pa.array(list(edge.values()), pa.int64()), pa.nulls(n, pa.string()), pa.array([-1] * n, pa.int32()), pa.array([NONE] * n, pa.int32()), pa.array(list(edge), pa.binary())], names=["doc_id", "part", "mask", "edge", "digest"])

    facts = scratch.keep(ranged.mapInArrow(judged, FACTS), "facts")
    before = facts.where("mask = -1").groupBy("digest").agg(F.min("doc_id").alias("least")).where("least is not null")
    bit = 1 << len(checks)
    repeated = F.when((F.col("edge") == HEAD) & (F.col("least") < F.col("doc_id")), F.col("mask").bitwiseOR(F.lit(bit))).otherwise(F.col("mask"))
    return facts.where("mask >= 0").join(F.broadcast(before), "digest", "left").select("doc_id", "part", repeated.alias("mask"))


def counters(found: DataFrame, labels: DataFrame | None, doc_id: str, flags: dict[str, str]) -> DataFrame:
    """Rows of part, mask, n and one count for each flag: what documents with just these failures are. Counts of two tables add up.

    Rows of one doc_id, part and mask are one row before they meet the labels; an id is flagged if any of its label rows is.
    """
    alike = found.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n"))
    if labels is not None:
        marks = labels.groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(*(F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(name) for name, c in flags.items()))
        alike = alike.join(marks, "doc_id", "left")
    else:
        alike = alike.withColumns({name: F.lit(0) for name in flags})
    return alike.groupBy("part", "mask").agg(F.sum("n").alias("n"), *(F.sum(F.col("n") * F.coalesce(name, F.lit(0))).alias(name) for name in flags))


def total(entries: Column, wanted: Callable[[Column], Column], value: Callable[[Column], Column]) -> Column:
    return F.aggregate(entries, F.lit(0).cast("long"), lambda s, e: s + F.when(wanted(e["mask"]), value(e)).otherwise(0))


def audit_filters(docs: DataFrame, labels: DataFrame | None = None, limits: Limits | None = None, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """What five filters remove in each order, by parts of a corpus.

    A: too few words; B: too few distinct ones; C: too many capitals; D: a symbol; E: the text of a smaller doc_id, in the whole
    table. Every document becomes a mask of failures; masks are counted by part (32 counters at most), and all that is said
    about orders follows from these counters.

    Null texts are empty: they fail A, and E beside a smaller id. Rows without doc_id never fail E, and have no labels. Rows
    that repeat a doc_id count each; among equal texts those of the least doc_id stay. A null part is ''. An empty
    table gives no rows. Other columns are not read, whatever their names.
    Columns: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.
    """
    limits = limits or Limits()
    scratch, letters = Scratch(docs.sparkSession, "filters"), [*limits.checks(), REPEATED]
    found = failures(docs, limits, scratch, doc_id, text, part)
    counts = counters(found, labels, doc_id, {"good": "quality", "toxic": "toxic"})
    of_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("e"))

    # one entry for each order and step: the bit of its filter, and those of the filters before
    bits = {letter: 1 << i for i, letter in enumerate(letters)}
    plan = [{"o": "".join(p), "k": k + 1, "b": bits[p[k]], "p": sum(bits[x] for x in p[:k])} for p in permutations(letters) for k in range(len(p))]
    steps = F.from_json(F.lit(json.dumps(plan)), "array<struct<o:string,k:int,b:int,p:int>>")
    at = of_part.select("part", "e", F.explode(steps).alias("s"))
    e, own, before = F.col("e"), F.col("s.b"), F.col("s.p")
    has = lambda m, b: m.bitwiseAND(b) != 0
    here = lambda m: has(m, own) & ~has(m, before)
    n = lambda x: x["n"]
    # in all orders together a document is removed by each of its failures equally often
    share = lambda x: x["n"] * (F.lit(factorial(len(letters))) / F.greatest(F.bit_count(x["mask"]), F.lit(1))).cast("long")
    return at.select(
        "part", F.col("s.o").alias("filter_order"), F.col("s.k").alias("step"),
        total(e, lambda m: ~has(m, before.bitwiseOR(own)), n).alias("kept"), total(e, here, n).alias("removed"), total(e, lambda m: has(m, own) & has(m, before), n).alias("redundant"),
        total(e, lambda m: m == own, n).alias("unique_fails"), total(e, here, lambda x: x["good"]).alias("good_lost"), total(e, here, lambda x: x["toxic"]).alias("toxic_lost"),
        total(e, lambda m: has(m, own), share).alias("shapley"),
    )
