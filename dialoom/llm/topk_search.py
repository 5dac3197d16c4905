"""Exact top-k search by inner product: MaxScore over the dimensions of integer vectors, shard by shard."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch

#: Bytes of a lot of queries as doubles, about. A lot is broadcast, so this bounds what the driver and every task hold of the queries.
LOT_BYTES = 16 << 20
#: Vectors of a shard looked at together, queries that share their essential terms, and terms probed before candidates are dropped again.
TILE, GROUP, PROBE = 4096, 64, 8
#: While more than one in so many vectors compete, terms are probed for all of a shard, as a product costs so much less for each.
MANY = 64
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def usable(lists: pa.ListArray, scale: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, their components as floor(scale * x)) for each length of vector. Rows that are null or hold a null or non-finite component are left out."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    offsets = lists.offsets.to_numpy()
    begin, lengths = offsets[:-1], np.diff(offsets)
    values = lists.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    with np.errstate(over="ignore", invalid="ignore"):
        values = np.floor(scale * values)
    there = lists.is_valid().to_numpy(zero_copy_only=False)
    out = []
    for n in np.unique(lengths[there]).tolist():
        rows = np.flatnonzero(there & (lengths == n))
        found = values[begin[rows][:, None] + np.arange(n)]
        good = np.isfinite(found).all(axis=1)
        if good.any():
            out.append((rows[good], found[good]))
    return out


class Best:
    """The k best candidates so far of each query: scores falling, ties by rising id. The last score is what a candidate must reach."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.k, self.own = k, ids
        # queries with a large component in the same place share their essential terms
        self.order = np.argsort(np.abs(vectors).argmax(axis=1), kind="stable") if vectors.shape[1] else np.arange(len(ids))
        self.vectors = vectors
        self.scores = np.full((len(ids), k), -np.inf)
        self.ids = np.full((len(ids), k), MOST)
        self.exact: dict[int, list[tuple[int, int]]] = {}  # (-score, id) of queries with scores beyond what doubles tell apart

    def add(self, q: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Candidates of queries q, which are those of a group."""
        good = scores >= self.scores[q, -1]
        q, scores, ids = q[good], scores[good], ids[good]
        touched = np.unique(q)
        if not len(touched):
            return
        q = np.concatenate([q, np.repeat(touched, self.k)])
        scores, ids = np.concatenate([scores, self.scores[touched].ravel()]), np.concatenate([ids, self.ids[touched].ravel()])
        order = np.lexsort((ids, -scores, q))
        q, scores, ids = q[order], scores[order], ids[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        first = rank < self.k
        self.scores[q[first], rank[first]], self.ids[q[first], rank[first]] = scores[first], ids[first]

    def see(self, ids: np.ndarray, tile: np.ndarray) -> None:
        """Take in vectors of a shard."""
        reach = float(np.abs(tile).max(initial=0)) * float(np.abs(self.vectors).max(initial=0)) * max(1, tile.shape[1])
        if reach >= 2.0**53:
            self.see_large(ids, tile)
            return
        kind = np.float32 if reach < 2.0**24 else np.float64  # sums of integers within these are exact
        postings = np.ascontiguousarray(tile.T.astype(kind))
        top, low = postings.max(axis=1), postings.min(axis=1)
        for at in range(0, len(self.order), GROUP):
            self.max_score(self.order[at : at + GROUP], ids, postings, top, low, kind)

    def max_score(self, group: np.ndarray, ids: np.ndarray, postings: np.ndarray, top: np.ndarray, low: np.ndarray, kind: type) -> None:
        """A group of queries over the postings (terms x vectors) of a shard.

        A term adds between `less` and `more` to a score. Terms are non-essential while a vector that has the most of all of these
        and the least of all others cannot reach what every query of the group asks for; only the others' postings are
        traversed. What is still competitive is probed for the non-essential terms, those of the widest bounds first.
        """
        queries = self.vectors[group].astype(kind)
        a, b = queries * top, queries * low
        more, less = np.maximum(a, b), np.minimum(a, b)
        least = self.scores[group, -1]
        order = np.argsort(-(more - less).max(axis=0), kind="stable")
        # reach[j]: the most that a vector at its least in the first j terms can score
        spread = (more - less)[:, order].astype(np.float64)
        reach = less.sum(axis=1, dtype=np.float64)[:, None] + np.concatenate([np.cumsum(spread[:, ::-1], axis=1)[:, ::-1], np.zeros((len(group), 1))], axis=1)
        live = reach[:, 0] >= least
        if not live.any():
            return
        group, queries, more, less, least = group[live], queries[live], more[live], less[live], least[live]
        n = int((reach[live] >= least[:, None]).sum(axis=1).max())  # reach falls, so these are the first terms; one more than may be non-essential is none
        n = min(n, len(order))
        scores = queries[:, order[:n]] @ postings[order[:n]]
        scores[self.own[group][:, None] == ids[None, :]] = -np.inf
        bound = np.maximum(least, -(2.0**60))  # above that of a query with itself, below all others
        while True:  # probe the next terms for all, by products, while many compete
            rest = order[n:]
            most = more[:, rest].sum(axis=1, dtype=np.float64)
            if scores.shape[1] >= self.k:  # what the k-th best has for certain
                sure = np.partition(scores, scores.shape[1] - self.k, axis=1)[:, -self.k] + less[:, rest].sum(axis=1, dtype=np.float64)
                bound = np.maximum(bound, sure)
            # a sum of scores and bounds is exact in double precision; what is left of it is compared as `kind` is
            competes = scores >= np.ceil(bound - most).astype(kind)[:, None]
            if not len(rest) or np.count_nonzero(competes) < scores.size // MANY:
                break
            terms = order[n : n + PROBE]
            scores += queries[:, terms] @ postings[terms]
            n += len(terms)
        q, v = np.nonzero(competes)
        found = scores[q, v].astype(np.float64)
        for at in range(0, len(rest), PROBE):  # then for each that competes
            if not len(q):
                return
            terms = rest[at : at + PROBE]
            found = found + np.einsum("ij,ji->i", queries[q][:, terms].astype(np.float64), postings[terms][:, v].astype(np.float64))
            most = most - more[:, terms].sum(axis=1, dtype=np.float64)
            good = found + most[q] >= bound[q]
            q, v, found = q[good], v[good], found[good]
        self.add(group[q], found, ids[v])

    def see_large(self, ids: np.ndarray, tile: np.ndarray) -> None:
        """The same by Python's integers, without bounds, for components so large that doubles do not hold the sums."""
        for i, own in enumerate(self.own.tolist()):
            query = [int(x) for x in self.vectors[i]]
            here = [(-min(max(sum(x * int(y) for x, y in zip(query, row, strict=True)), LEAST), MOST), key) for key, row in zip(ids.tolist(), tile, strict=True) if key != own]
            self.exact[i] = sorted(self.exact.get(i, []) + here)[: self.k]

    def results(self) -> list[tuple[int, int, int]]:
        """(number of query, id, score)."""
        out = []
        for i in range(len(self.own)):
            found = [(-int(s), c) for s, c in zip(self.scores[i].tolist(), self.ids[i].tolist(), strict=True) if s > -np.inf]
            out += [(i, c, -s) for s, c in sorted(found + self.exact.get(i, []))[: self.k]]
        return out


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: float = 256, vec_id: str = "vec_id", embedding: str = "embedding", lot_bytes: int = LOT_BYTES) -> DataFrame:
    """The k best candidates of every query by the inner product of floor(scale * x). Queries: rows whose vec_id `every` divides.

    Queries go out in lots of bounded bytes; for each lot every task searches its part of the table (a shard) and gives at most
    k candidates a query, and these lists are merged. So vectors are not moved, and no task sees more than a shard.

    Candidates are all rows of another vec_id and as many components; ties go to the smaller vec_id. Rows without vec_id, and vectors that are null
    or hold a null or non-finite component (or one that `scale` makes non-finite), take no part. Each row that repeats a query is a
    query, and each that repeats a candidate a candidate. Empty vectors score 0 with each other. A score beyond 64 bits counts as the nearest
    long. An empty table, or one without queries, gives no rows. Extra columns are not read.
    Columns: query_id, rank, vec_id, score.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession, "top-k")
    source = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding")).where("vec_id is not null")
    asked = scratch.keep(source.where(F.col("vec_id") % every == 0).withColumn("row", F.monotonically_increasing_id()), "queries")
    size = asked.agg(F.coalesce(F.sum(F.greatest(F.size("embedding"), F.lit(1)) + 2), F.lit(0))).first()[0]
    lots = max(1, -(-8 * size // lot_bytes))
    results = []
    for lot in range(lots):
        mine = asked.where(F.pmod(F.xxhash64("row"), F.lit(lots)) == lot).toArrow()
        keys = mine.column("vec_id").to_numpy()
        batch = spark.sparkContext.broadcast([(keys[rows], mine.column("row").to_numpy()[rows], found) for rows, found in usable(mine.column("embedding"), scale)])

        def search(batches, batch=batch):
            best = {found.shape[1]: Best(ids, found, k) for ids, _, found in batch.value}
            for part in batches:
                for at in range(0, part.num_rows, TILE):
                    tile = part.slice(at, TILE)
                    ids = tile.column("vec_id").to_numpy()
                    for rows, found in usable(tile.column("embedding"), scale):
                        if found.shape[1] in best:
                            best[found.shape[1]].see(ids[rows], found)
            for keys, numbers, found in batch.value:
                out = best[found.shape[1]].results()
                i = np.array([x for x, _, _ in out], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(numbers[i]), pa.array(keys[i]), pa.array([c for _, c, _ in out], pa.int64()), pa.array([s for _, _, s in out], pa.int64())], names=["row", "query_id", "vec_id", "score"])

        found = source.mapInArrow(search, "row long, query_id long, vec_id long, score long")
        order = Window.partitionBy("row", "query_id").orderBy(F.desc("score"), "vec_id")
        results.append(scratch.keep(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), f"lot-{lot}"))
        batch.unpersist()
    every_lot = spark.read.schema(results[0].schema).parquet(*(f"{scratch.root}/lot-{lot}" for lot in range(lots)))
    return every_lot.select("query_id", "rank", "vec_id", "score")
