"""Balanced sharding by longest-processing-time scheduling."""

from __future__ import annotations

import heapq
from itertools import groupby

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch

#: Bytes that a row has besides its text.
ROW_BYTES = 16
#: Units of work a shard is made of, on average. Bounds what the driver schedules: at most 4 * UNITS * shards rows.
UNITS = 256
#: One in so many light groups goes to a fine unit, which evens out the end of the schedule.
FINE = 16


def schedule(sizes: list[tuple[int, int]], shards: int) -> dict[int, int]:
    """Longest processing time first: (unit, size) by falling size, each to the least-loaded shard."""
    heap = [(0, s) for s in range(shards)]
    placed = {}
    for unit, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        placed[unit] = shard
    return placed


def assign_shards(docs: DataFrame, shards: int = 40, doc_id: str = "doc_id", text: str = "text", units: int = UNITS) -> DataFrame:
    """Shard and slot of every row; rows of equal text stay together and shards are near equal in bytes.

    A group is all rows of one text. Groups of at least 1/(units*shards) of all bytes are scheduled one by one, of which
    there are at most units*shards; lighter groups are first bundled by hash into as many bundles, and again as many fine
    ones, so the driver never holds more than a fixed number of rows. Slots are numbered by (unit, part) offsets, so no
    task holds a whole shard: a group larger than a unit is dealt into parts by row, so rows that share a doc_id, or have none, are too.

    Null and empty texts are one group of rows of ROW_BYTES bytes with checksum 0. Repeated rows each have a slot. An
    empty table gives no rows. Other columns of `docs`, whatever their names, are not read.
    Columns: doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law).
    """
    spark, most = docs.sparkSession, units * shards
    scratch = Scratch(spark, "sharding")
    body = F.coalesce(F.col(text), F.lit(""))
    # xxhash64 decides what stays together: texts that collide would only share a shard
    rows = scratch.keep(docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"), F.xxhash64(body).alias("key"), F.monotonically_increasing_id().alias("row_id")), "rows")
    groups = scratch.keep(rows.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("n")), "groups")
    total, n_rows = groups.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    light_below = total / most

    spread = F.xxhash64("key", F.lit(9))
    bundle = F.pmod(F.floor(spread / 64), F.lit(most)) + F.when(F.pmod(spread, F.lit(FINE)) == 0, most).otherwise(0)
    heavy = [(r.key, r.size, r.n) for r in groups.where(F.col("size") >= light_below).select("key", "size", "n").collect()]
    light = [(r.unit, r.size, r.n) for r in groups.where(F.col("size") < light_below).groupBy(bundle.alias("unit")).agg(F.sum("size").alias("size"), F.sum("n").alias("n")).collect()]

    # light units are numbered from 0, heavy ones from 2 * most
    heavy_unit = {key: 2 * most + i for i, (key, _, _) in enumerate(sorted(heavy))}
    sizes = [(heavy_unit[k], s) for k, s, _ in heavy] + [(u, s) for u, s, _ in light]
    shard_of = schedule(sizes, shards)
    per_part = max(1, -(-n_rows // most))
    parts = {heavy_unit[k]: -(-n // per_part) for k, _, n in heavy} | {u: -(-n // per_part) for u, _, n in light}

    heavy_table = spark.createDataFrame([(k, u) for k, u in heavy_unit.items()], "key long, heavy_unit long")
    parts_table = spark.createDataFrame([(u, p) for u, p in parts.items()], "unit long, parts long")
    dealt = (
        rows.join(F.broadcast(heavy_table), "key", "left")
        .withColumn("unit", F.coalesce("heavy_unit", bundle))
        .join(F.broadcast(parts_table), "unit")
        .withColumn("part", F.pmod(F.xxhash64("row_id", F.lit(1)), F.col("parts")))
    )
    dealt = scratch.keep(dealt.select("doc_id", "size", "text_crc32", "unit", "part"), "dealt")
    counts = sorted((shard_of[r.unit], r.unit, r.part, r["count"]) for r in dealt.groupBy("unit", "part").count().collect())
    offsets = []
    for shard, inside in groupby(counts, key=lambda x: x[0]):
        start = 0
        for _, unit, part, n in inside:
            offsets.append((unit, part, shard, start))
            start += n
    at = spark.createDataFrame(offsets, "unit long, part long, shard int, start long")
    order = Window.partitionBy("unit", "part").orderBy("doc_id", "text_crc32", "size")
    return dealt.withColumn("row", F.row_number().over(order)).join(F.broadcast(at), ["unit", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("start") + F.col("row") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
