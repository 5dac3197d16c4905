"""Near-duplicate vectors by quantised tile products with rigorous error bounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import Scratch, release

#: Vectors in a tile, about, and of a tile in one product. A label's vectors go to every tile of their label, so tiles are large.
TILE, PRODUCT = 8192, 2048
LEVELS = 127


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; their largest component is made 1 first, as squares of very large or small ones are out of range."""
    vectors = vectors / np.abs(vectors).max(axis=1)[:, None]
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors as 8-bit integers, their scales, and a bound on the length of each one's rounding error."""
    scale = np.abs(units).max(axis=1) / LEVELS
    levels = np.rint(units / scale[:, None])
    error = units - levels * scale[:, None]
    return levels.astype(np.int8), scale, np.sqrt(np.einsum("ij,ij->i", error, error)) * (1 + 1e-9) + 1e-12


def close_pairs(left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows i of left and j of right, both unit vectors, whose cosine in double precision is at least the threshold.

    x.y differs from the product of the quantised vectors by at most e(x) + e(y) + e(x) e(y), with e the length of a
    rounding error, as unit vectors have length 1; pairs below the threshold by more are not looked at again. Products
    of 8-bit integers are exact in single precision up to 2**24.
    """
    if max(len(left), len(right)) > PRODUCT:
        found = []
        for i in range(0, len(left), PRODUCT):
            for j in range(0, len(right), PRODUCT):
                x, y = close_pairs(left[i : i + PRODUCT], right[j : j + PRODUCT], threshold)
                found.append((x + i, y + j))
        return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])
    (a, scale_a, error_a), (b, scale_b, error_b) = quantised(left), quantised(right)
    kind = np.float32 if left.shape[1] * LEVELS * LEVELS < 1 << 24 else np.float64
    products = (a.astype(kind) @ b.T.astype(kind)).astype(np.float64) * scale_a[:, None] * scale_b[None, :]
    i, j = np.nonzero(products + (error_a[:, None] + error_b[None, :] + error_a[:, None] * error_b[None, :]) >= threshold - 1e-12)
    exact = np.empty(len(i))
    for at in range(0, len(i), 1 << 16):
        part = slice(at, at + (1 << 16))
        exact[part] = np.einsum("ij,ij->i", left[i[part]], right[j[part]])
    good = exact >= threshold
    return i[good], j[good]


def near_vectors(vectors: DataFrame, threshold: float = 0.93, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", tile: int = TILE) -> DataFrame:
    """Links between vectors of one label with a cosine of at least the threshold, and their components.

    Equal vectors of a label are one class: they link with one another, and one stands for all. Classes of a label are
    dealt into tiles; every pair of tiles is a task of its own, so the work of a large label spreads over all tasks. A
    tile product sends on, for each vector, its number of links in the other tile (weighted by class sizes) and one link
    to each component found inside the product, not its links.

    Vectors that are null, empty or zero, or hold a null or non-finite component, link with nothing, as do rows with a
    null label; vectors of different lengths do not link. Rows without vec_id are rows without links. Rows that share a
    vec_id are one node, with the links of all. An empty table gives no rows. Extra columns are not read.
    Columns: vec_id, n_links, component_id, kept (vec_id = component_id; true without vec_id).
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession, "vectors")
    e = F.col("embedding")
    source = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"), F.col(label).alias("label"))
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    # negative zero and zero are equal numbers, but not equal bytes
    usable = source.where("vec_id is not null and label is not null and embedding is not null").where(finite).withColumn("embedding", F.transform(e, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)))
    usable = usable.dropDuplicates(["vec_id", "label", "embedding"])
    keyed = scratch.keep(usable.withColumn("key", F.sha2(F.to_json(F.struct("label", "embedding")), 256)), "keyed")
    classes = scratch.keep(keyed.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("embedding").alias("embedding")), "classes")
    label_tiles = classes.groupBy("label").agg(F.ceil(F.count("*") / tile).cast("long").alias("tiles"))
    dealt = classes.join(label_tiles, "label").withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")))
    # every class goes to the products of its tile with all tiles of its label
    sides = dealt.select("label", "tile", "rep", "copies", "embedding", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other"))
    sides = sides.select("label", F.least("tile", "other").alias("p"), F.greatest("tile", "other").alias("q"), "tile", "rep", "copies", "embedding")

    def product(table: pa.Table) -> pa.Table:
        p, q = table.column("p")[0].as_py(), table.column("q")[0].as_py()
        tiles, reps, copies = (table.column(c).to_numpy() for c in ("tile", "rep", "copies"))
        lists = table.column("embedding").combine_chunks()
        lengths = np.diff(lists.offsets.to_numpy())
        values = lists.flatten().to_numpy()
        begin = np.cumsum(lengths) - lengths
        n_links, edges = np.zeros(len(reps), np.int64), []
        for width in np.unique(lengths).tolist():
            mine = np.flatnonzero(lengths == width)
            units = unit(values[begin[mine][:, None] + np.arange(width)])
            left, right = mine[tiles[mine] == p], mine[tiles[mine] == q]
            i, j = close_pairs(units[tiles[mine] == p], units[tiles[mine] == q], threshold)
            if p == q:
                i, j = i[i != j], j[i != j]
            i, j = left[i], right[j]
            np.add.at(n_links, i, copies[j])
            if p != q:
                np.add.at(n_links, j, copies[i])
            edges += spanning(i, j, reps)
        hit = np.flatnonzero(n_links)
        u = np.concatenate([reps[hit], np.array([a for a, _ in edges], np.int64)])
        v = np.concatenate([np.full(len(hit), -1), np.array([b for _, b in edges], np.int64)])
        n = np.concatenate([n_links[hit], np.zeros(len(edges), np.int64)])
        return pa.table({"rep": u, "n": n, "linked": np.concatenate([np.zeros(len(hit), bool), np.ones(len(edges), bool)]), "other": v})

    found = scratch.keep(sides.groupBy("label", "p", "q").applyInArrow(product, "rep long, n long, linked boolean, other long"), "found")
    release(spark)
    # a vector can be the representative of classes of several labels; its links are those of all
    counts = keyed.join(classes.select("key", "rep", "copies"), "key").join(found.where("not linked").groupBy("rep").agg(F.sum("n").alias("n")), "rep", "left")
    per_vector = counts.groupBy("vec_id").agg(F.sum(F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    members = keyed.join(classes.select("key", "rep"), "key").select(F.col("vec_id").alias("u"), F.col("rep").alias("v"))
    edges = found.where("linked").select(F.col("rep").alias("u"), F.col("other").alias("v")).unionByName(members)
    labels = connected_components(edges, scratch, "cc")
    out = source.select("vec_id").join(per_vector, "vec_id", "left").join(labels.select(F.col("node").alias("vec_id"), "label"), "vec_id", "left")
    component = F.coalesce("label", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def spanning(i: np.ndarray, j: np.ndarray, reps: np.ndarray) -> list[tuple[int, int]]:
    """Links that join as much as all links i, j do, without a cycle."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in zip(reps[i].tolist(), reps[j].tolist(), strict=True):
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((a, b))
    return out
