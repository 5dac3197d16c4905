"""Reproducible samples. The driver draws positions from counts alone; rows never leave the executors."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import score_bin
from .pairs import keyed

#: Drawn positions that are broadcast; more are joined by their keys.
BROADCAST_PICKS = 200_000


def with_picks(rows: DataFrame, picks: list[tuple], schema: str) -> DataFrame:
    """The rows at drawn positions."""
    table = rows.sparkSession.createDataFrame(picks, schema)
    return rows.join(F.broadcast(table) if len(picks) <= BROADCAST_PICKS else table, table.columns, "left_semi")


def per_split(rows: DataFrame, k: int, seed: int = 42, splits: list[str] | None = None) -> DataFrame:
    """k rows of every split (0: all), by one generator over the splits in order."""
    sizes = {r.split: r.n for r in rows.groupBy("split").agg(F.count("*").alias("n")).collect()}
    if k <= 0:
        return rows.where(F.col("split").isin(splits)) if splits else rows
    draw, picks = random.Random(seed), []
    for split in splits or sorted(sizes):
        n = sizes.get(split, 0)
        picks += [(split, i) for i in sorted(draw.sample(range(n), min(k, n)))]
    return with_picks(rows, picks, "split string, row_idx long")


def stratified(rows: DataFrame, by: str, k: int, seed: int = 42) -> DataFrame:
    """k rows of every value in every split (0: none), with the value's count over all splits. Places inside a value are numbered in blocks (see keyed)."""
    valued = rows.withColumn("value", F.col(by).cast("string"))
    pooled = valued.withColumn("_pool", F.to_json(F.struct("split", "value")))
    sizes = sorted((r.split, str(r.value), r._pool, r.n) for r in pooled.groupBy("split", "value", "_pool").agg(F.count("*").alias("n")).collect())
    draw, picks = random.Random(seed), []
    for _, _, pool, n in sizes:
        picks += [(pool, i) for i in sorted(draw.sample(range(n), min(k, n)))]
    totals = valued.groupBy("value").agg(F.count("*").alias("group_count"))
    placed = keyed(pooled.withColumnsRenamed({"split": "_split", "row_idx": "_row"}), ["_row"], "_pool")
    chosen = with_picks(placed, picks, "split string, row_idx long").drop("split", "row_idx", "_pool").withColumnsRenamed({"_split": "split", "_row": "row_idx"})
    return chosen.join(totals, chosen["value"].eqNullSafe(totals["value"])).drop(totals["value"])


def interleaved(rows: DataFrame, pool: str, order: str, total: int) -> DataFrame:
    """Rows of the pools in turn, one of each, until there are so many."""
    turn = F.row_number().over(Window.partitionBy(pool).orderBy(order))
    return rows.withColumn("turn", turn).where(F.col("turn") <= total).orderBy("turn", pool).limit(total)


class Shuffled:
    """The places 0..n-1 in the order that random.shuffle gives them, from the end; only what a swap displaced is held.

    A shuffle draws a place for each position from the last one down, and what is swapped into a position stays there. So the
    last places are known after as many draws, and the rest need not be listed. `skip` makes the draws that a
    whole shuffle would have made, so what is drawn later from the same generator is the same.
    """

    def __init__(self, n: int, draw: random.Random):
        self.left, self.draw, self.moved = n, draw, {}
        self.at = n - 1  # the next position that a swap settles

    def pop(self) -> int:
        self.left -= 1
        if self.at >= 1:
            i, j = self.at, self.draw._randbelow(self.at + 1)
            self.at -= 1
            out = self.moved.get(j, j)
            last = self.moved.pop(i, i)
            if j != i:
                self.moved[j] = last
            return out
        return self.moved.get(0, 0)

    def skip(self) -> None:
        while self.at >= 1:
            self.draw._randbelow(self.at + 1)
            self.at -= 1


def drawn_in_turn(sizes: dict[str, int], total: int, draw: random.Random) -> list[tuple[str, int]]:
    """(pool, place): every pool shuffled, then one of each from the end in turn, until there are so many or none are left.

    Memory is for what is drawn, not for the pools. How many each pool gives follows from the sizes, so each one is
    drawn from while its own shuffle is made.
    """
    pools = sorted(sizes)
    given = dict.fromkeys(pools, 0)
    level, left, open_pools = 0, total, [p for p in pools if sizes[p]]
    while left > 0 and open_pools:  # whole rounds until the smallest pool ends
        rounds = min(min(sizes[p] for p in open_pools) - level, left // len(open_pools))
        if rounds == 0:
            for p in open_pools[:left]:
                given[p] += 1
            break
        for p in open_pools:
            given[p] += rounds
        level, left = level + rounds, left - rounds * len(open_pools)
        open_pools = [p for p in open_pools if sizes[p] > level]
    drawn: dict[str, list[int]] = {}
    for p in pools:
        if before := getattr(draw, "unfinished", None):  # only who draws after a pool pays for the rest of its shuffle
            before.skip()
        shuffled = draw.unfinished = Shuffled(sizes[p], draw)
        drawn[p] = [shuffled.pop() for _ in range(given[p])]
    return [(p, drawn[p][i]) for i in range(max(given.values(), default=0)) for p in pools if i < given[p]]


def benchmark_sample(rows: DataFrame, per_pair: int = 0, total: int = 0, thresholds: list[float] = (), seed: int = 42) -> DataFrame:
    """Rows (dataset_idx, lp, score) of a benchmark: so many of each language pair, or in all, or every one; with thresholds evenly over score bins.

    Only the sizes of pairs and bins reach the driver, as a draw depends on nothing else, and the places that are drawn. The result is in no order; the record's is lp, dataset_idx.
    """
    if per_pair <= 0 and total <= 0:
        return rows
    bins = score_bin(F.col("score"), list(thresholds)) if thresholds else F.lit("")
    sized = rows.withColumn("_bin", bins)
    sizes = sorted((r.first, r.lp, r._bin, r.n) for r in sized.groupBy("lp", "_bin").agg(F.count("*").alias("n"), F.min("dataset_idx").alias("first")).collect())
    by_pair: dict[str, dict[str, int]] = {}
    for _, lp, name, n in sizes:  # pairs in the order of their first rows
        by_pair.setdefault(lp, {})[name] = n
    draw, picks = random.Random(seed), []
    if per_pair > 0:
        for lp in sorted(by_pair):
            size = sum(by_pair[lp].values())
            n = min(per_pair, size)
            if thresholds:
                picks += [(f"{lp}::{name}", place) for name, place in drawn_in_turn(by_pair[lp], n, draw)]
            else:
                picks += [(f"{lp}::", place) for place in draw.sample(range(size), n)]
    else:
        size = sum(n for *_, n in sizes)
        if thresholds:
            pools = {f"{lp}::{name}": n for lp, names in by_pair.items() for name, n in names.items()}
            picks = drawn_in_turn(pools, min(total, size), draw)
        else:
            starts, at = [], 0
            for lp, names in by_pair.items():
                starts.append((at, lp))
                at += sum(names.values())
            for position in draw.sample(range(size), min(total, size)):
                start, lp = max(x for x in starts if x[0] <= position)
                picks.append((f"{lp}::", position - start))
    placed = keyed(sized.withColumn("_pool", F.concat("lp", F.lit("::"), "_bin")), ["dataset_idx"], "_pool")
    return with_picks(placed, picks, "split string, row_idx long").select(*rows.columns)


def benchmark_rows(rows: DataFrame, pairs: list[str] = (), domains: list[str] = (), years: list[int] = (), max_source: int = 0, max_translation: int = 0) -> DataFrame:
    """Rows fit for a benchmark: known language pair, domain and year where given, lengths in bounds (0: none), texts not blank."""
    keep = (F.trim("src") != "") & (F.trim("mt") != "")
    for column, allowed in (("lp", pairs), ("domain", domains), ("year", years)):
        if allowed:
            keep &= F.coalesce(F.col(column).isin(list(allowed)), F.lit(False))
    for column, most in (("src", max_source), ("mt", max_translation)):
        if most:
            keep &= F.char_length(column) <= most
    return rows.where(keep)
