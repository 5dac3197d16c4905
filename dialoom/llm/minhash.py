"""Near-duplicate documents by MinHash, confirmed on full shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from .components import connected_components
from .shared import Scratch, map_arrow, release, sliced

#: Production size: at a similarity of 0.8 a pair shares no band with a probability of (1 - 0.8**4)**32 = 5e-8.
BANDS, ROWS = 32, 4
#: Members that are compared with one copy of a pivot's text.
FAN = 256
#: Rounds after which members far from their pivot are described by their differences from it too, instead of having a pivot of their own.
ROUNDS = 2
#: A pivot whose members meet more often than this a member is compared in tiles. Both ways join the same components.
CROWD = 16
#: Members of a tile and differences of all its members together, about.
TILE, TILE_DIFFERENCES = 4096, 2_000_000
#: Words whose hashes a worker remembers; the memory starts anew when it is full.
CACHE_WORDS = 400_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Vocabulary(dict):
    """word -> number, in the order of first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class WordHashes:
    def __init__(self):
        self.ids, self.hashes = Vocabulary(), np.empty(0, np.uint64)

    def of(self, words: list[bytes]) -> np.ndarray:
        """The hash of each word."""
        if len(self.ids) > CACHE_WORDS:
            self.__init__()
        known = len(self.ids)
        at = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
        if len(self.ids) > known:
            new = list(self.ids)[known:] if known else list(self.ids)
            blob = b"".join(hashlib.blake2b(w, digest_size=8).digest() for w in new)
            self.hashes = np.concatenate([self.hashes, np.frombuffer(blob, np.uint64)])
        return self.hashes[at]


WORD_HASHES = WordHashes()


def words_of(text: str | None) -> list[bytes]:
    """Words between the bytes 0x20 and 0x09-0x0D, with A-Z in lower case."""
    return (text or "").encode("utf-8", "replace").lower().split()


def shingle_set(text: str | None, size: int) -> set:
    """Distinct runs of `size` words; with fewer words, all of them as one; without words, nothing."""
    words = words_of(text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size)), strict=False))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    n = max(1, len(hashes) - size + 1)
    out = np.full(n, size if len(hashes) >= size else len(hashes), np.uint64)
    for i in range(min(size, len(hashes))):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n])
    return np.unique(out)


class MinHasher:
    """Universal hashing of 32-bit keys: the upper half of a*x + b in 64 bits, with drawn a and b."""

    def __init__(self, bands: int, rows: int, seed: int = 20240229):
        draw = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = draw.integers(1, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = draw.integers(0, 2**63, bands * rows, dtype=np.uint64)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        x, low = (shingles >> np.uint64(32)), None
        for at in range(0, len(x), 2048):
            h = np.multiply.outer(x[at : at + 2048], self.a)
            h += self.b
            part = h.min(axis=0) >> np.uint64(32)
            low = part if low is None else np.minimum(low, part)
        return low

    def band_hashes(self, signatures: np.ndarray) -> np.ndarray:
        """(n, bands): one key for each band, different between bands."""
        parts = signatures.reshape(len(signatures), self.bands, self.rows)
        out = np.broadcast_to(np.arange(1, self.bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
        for i in range(self.rows):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
        return out


def signatures(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_key (of the whole set), bands, sketch (the low byte of every minimum)."""
    hasher = MinHasher(bands, rows)

    def run(batch: pa.RecordBatch) -> dict:
        texts = batch.column("text").to_pylist()
        counts, keys, minima, with_set = [], [], [], []
        split = [words_of(t) for t in texts]
        hashes = WORD_HASHES.of([w for words in split for w in words])
        at = 0
        for words in split:
            mine, at = hashes[at : at + len(words)], at + len(words)
            if not len(mine):
                counts.append(0)
                keys.append(None)
                with_set.append(False)
                continue
            shingles = shingle_hashes(mine, shingle)
            counts.append(len(shingles))
            keys.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
            minima.append(hasher.signature(shingles))
            with_set.append(True)
        all_minima = np.array(minima, np.uint64).reshape(-1, bands * rows)
        found_bands = iter(hasher.band_hashes(all_minima).view(np.int64).tolist())
        sketches = iter(all_minima.astype(np.uint8))
        return {
            "doc_id": batch.column("doc_id"),
            "text_hash": batch.column("text_hash"),
            "n_shingles": counts,
            "set_key": keys,
            "bands": [next(found_bands) if x else None for x in with_set],
            "sketch": [next(sketches).tobytes() if x else None for x in with_set],
        }

    return map_arrow(docs, run, "doc_id long, text_hash long, n_shingles long, set_key binary, bands array<long>, sketch binary", most=2 << 20)


def least_equal(hashes: int, similarity: float) -> int:
    """Equal minima that a pair of that similarity has, but for a probability of 3e-6 (4.5 standard deviations below the mean)."""
    return max(0, int(hashes * similarity - 4.5 * (hashes * similarity * (1 - similarity)) ** 0.5))


def equal_minima(pairs: DataFrame, sketches: DataFrame, floor: float, hashes: int) -> DataFrame:
    """Of rows a, b, apart those whose set sizes and signatures allow a similarity of `floor`, with set sizes and number of equal minima.

    Chance equality of low bytes only lets more pairs through.
    """
    least = least_equal(hashes, floor) if floor else 0
    side = lambda c: sketches.select(F.col("node").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(f"least(n_a, n_b) >= {floor} * greatest(n_a, n_b)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, hashes) for c in ("s_a", "s_b"))
                same = (left == right).sum(axis=1)
                out = batch.select(["a", "b", "apart", "n_a", "n_b"]).append_column("same", pa.array(same, pa.int64()))
                yield out.filter(pa.array(same >= least))

    return both.select("a", "b", "apart", "n_a", "n_b", "s_a", "s_b").mapInArrow(run, "a long, b long, apart boolean, n_a long, n_b long, same long")


def beside_pivots(pairs: DataFrame, texts: DataFrame, shingle: int, each: Callable[[set, set], tuple | None], schema: str) -> DataFrame:
    """For rows a, b what `each` gives for the full shingle sets of both. A text b goes to the pivot a, whose text goes to every FAN of its members."""
    fans = pairs.groupBy("a").agg(F.ceil(F.count("*") / FAN).cast("long").alias("fans"))
    members = pairs.join(fans, "a").select("a", F.pmod(F.xxhash64("b"), F.col("fans")).alias("fan"), F.col("b").alias("node"))
    pivots = fans.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("fans") - 1)).alias("fan"), F.col("a").alias("node"))
    rows = members.unionByName(pivots).join(texts, "node").select("a", "fan", (F.col("node") != F.col("a")).alias("member"), "node", "text")
    dealt = rows.repartition("a", "fan").sortWithinPartitions("a", "fan", "member")
    kind = _parse_datatype_string(f"a long, b long{schema}")
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, own = None, set()
        for batch in batches:
            for part in sliced([batch], most=1 << 20):
                out = []
                for left, right, text in zip(*(part.column(c).to_pylist() for c in ("a", "node", "text")), strict=True):
                    found = shingle_set(text, shingle)
                    if left == right:
                        pivot, own = left, found
                        continue
                    assert pivot == left, "a member came before its pivot"
                    said = each(own, found)
                    if said is not None:
                        out.append((left, right, *said))
                columns = zip(*out, strict=True) if out else [[]] * len(arrow)
                yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(columns, arrow, strict=True)], schema=arrow)

    return dealt.mapInArrow(run, kind)


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int, shingle: int) -> DataFrame:
    """Of rows a, b those whose full shingle sets are similar."""

    def each(own: set, found: set) -> tuple | None:
        both = len(own & found)
        return () if 100 * both >= percent * (len(own) + len(found) - both) else None

    return beside_pivots(pairs, texts, shingle, each, "")


def differences(pairs: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """For rows a, b: the pivot's set size, how many of its shingles b lacks, how many b has besides, and the hashes of all these."""

    def key(words: tuple) -> int:
        return int.from_bytes(hashlib.blake2b(b" ".join(words), digest_size=8).digest(), "little", signed=True)

    def each(own: set, found: set) -> tuple:
        lost, added = own - found, found - own
        return len(own), len(lost), len(added), [key(x) for x in lost] + [key(x) for x in added]

    return beside_pivots(pairs, texts, shingle, each, ", size long, lost long, added long, differences array<long>")


def linkable(described: DataFrame, percent: int, scratch: Scratch | None = None, name: str = "") -> DataFrame:
    """Pairs a, b of members of one pivot, of different labels, that share enough differences from the pivot to be similar.

    described: pivot, node, label, size, lost, added, differences. With s shared differences, x and y share
    size - lost(x) - lost(y) + s shingles, so they are similar if and only if (100 + percent) * s >= g(x) + g(y) - base,
    with g = 100 * lost + percent * added and base = (100 - percent) * size. A member with g <= base is similar to the pivot;
    of a pair that is not linked through it one has more, so the pair shares a difference. In one order of a pivot's
    differences, rare ones first, the first shared one has at least s from there on in both, itself included: the pair is
    met at a difference from which on both have enough. Most copies that were edited apart share none of their rare ones.

    Members that are mixtures of the same parts do share them, so nearly all pairs of them would be met. With `scratch`,
    pivots whose members meet more than CROWD times each are told from counts and go by tiles instead (see tile_links),
    which give not these pairs but links enough to join what they join. So rows grow with the members, not with their pairs.
    """
    scale = 100 + percent
    measured = described.select("pivot", "node", "label", (100 * F.col("lost") + percent * F.col("added")).alias("g"), ((100 - percent) * F.col("size")).alias("base"), "differences")
    each = measured.select("pivot", "node", "label", "g", "base", F.explode("differences").alias("d"))
    common = each.groupBy("pivot", "d").agg(F.count("*").alias("n")).where("n > 1")
    ranked = each.join(common, ["pivot", "d"]).groupBy("pivot", "node").agg(*(F.first(c).alias(c) for c in ("label", "g", "base")), F.sort_array(F.collect_list(F.struct("n", "d"))).alias("ds"))
    ranked = ranked.withColumn("far", F.col("g") > F.col("base"))
    if scratch is None:
        return met(ranked, scale)
    ranked = scratch.keep(ranked, f"ranked{name}")
    at_each = places(ranked, scale).groupBy("pivot", "d").agg(F.count("*").alias("n"), F.count_if("far").alias("far"))
    members = ranked.groupBy("pivot").agg(F.count("*").alias("members"))
    crowded = at_each.groupBy("pivot").agg(F.sum(F.col("n").cast("double") * F.col("far")).alias("meetings")).join(members, "pivot").where(f"meetings > {CROWD} * members")
    crowded = scratch.keep(crowded.select("pivot"), f"crowded{name}")
    pairs = met(ranked.join(crowded, "pivot", "left_anti"), scale)
    return pairs if crowded.isEmpty() else pairs.unionByName(tile_links(ranked.join(crowded, "pivot", "left_semi"), scale))


def places(ranked: DataFrame, scale: int) -> DataFrame:
    """The differences at which a member can be met first by one similar to it."""
    placed = ranked.select("pivot", "node", "label", "g", "base", "far", F.size("ds").alias("k"), F.posexplode("ds").alias("at", "of"))
    rest = F.col("k") - F.col("at")  # differences from here on; those of one member alone are none of them
    return placed.select("pivot", F.col("of.d").alias("d"), "node", "label", "g", "far", (scale * rest - F.col("g") + F.col("base")).alias("most")).where("most >= 0")


def met(ranked: DataFrame, scale: int) -> DataFrame:
    placed = places(ranked, scale)
    left = placed.where("far").select("pivot", "d", *(F.col(c).alias(f"{c}_a") for c in ("node", "label", "g", "most")))
    right = placed.select("pivot", "d", *(F.col(c).alias(f"{c}_b") for c in ("node", "label", "g", "most", "far")))
    both = left.join(right, ["pivot", "d"]).where("label_a <> label_b and g_b <= most_a and g_a <= most_b and (not far_b or node_a < node_b)")
    return both.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def tile_links(ranked: DataFrame, scale: int, tile: int = 0, tile_differences: int = 0) -> DataFrame:
    """Links a, b between members of one pivot that join all labels which any similar pair of them joins.

    Members are dealt into tiles of bounded numbers of members and of differences; every pair of tiles of which one holds
    members far from the pivot is a task's group. It counts the shared differences of all its pairs as a product of bit
    matrices, and sends on one link for each two components that it joins: fewer links than it has members, never its pairs.
    """
    count = F.count("*") / (tile or TILE)
    differences = F.sum(F.size("ds")) / (tile_differences or TILE_DIFFERENCES)
    kinds = ranked.groupBy("pivot", "far").agg(F.ceil(F.greatest(count, differences)).cast("long").alias("tiles"))
    numbers = kinds.groupBy("pivot").agg(*(F.coalesce(F.max(F.when(when, F.col("tiles"))), F.lit(0)).alias(c) for c, when in (("fars", F.col("far")), ("nears", ~F.col("far")))))
    # tiles of far members come first, the others after them
    at = F.when(F.col("far"), F.pmod(F.xxhash64("node"), F.col("fars"))).otherwise(F.col("fars") + F.pmod(F.xxhash64("node"), F.col("nears")))
    dealt = ranked.join(numbers.where("fars > 0"), "pivot").withColumn("tile", at)
    others = F.sequence(F.lit(0).cast("long"), F.when(F.col("far"), F.col("fars") + F.col("nears")).otherwise(F.col("fars")) - 1)
    sides = dealt.select("pivot", "tile", "node", "label", "g", "base", F.transform("ds", lambda x: x.d).alias("ds"), F.explode(others).alias("other"))
    sides = sides.select("pivot", F.least("tile", "other").alias("p"), F.greatest("tile", "other").alias("q"), "tile", "node", "label", "g", "base", "ds")

    def links(table: pa.Table) -> pa.Table:
        p, q, base = (table.column(c)[0].as_py() for c in ("p", "q", "base"))
        tiles, nodes, labels, g = (table.column(c).to_numpy() for c in ("tile", "node", "label", "g"))
        lists = table.column("ds").combine_chunks()
        lengths, values = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
        rows = np.repeat(np.arange(len(nodes)), lengths)
        left, right = np.flatnonzero(tiles == p), np.flatnonzero(tiles == q)
        place = np.empty(len(nodes), np.int64)
        sides = []
        for mine, number in ((left, p), (right, q)):
            place[mine] = np.arange(len(mine))
            held = tiles[rows] == number
            sides.append((values[held], place[rows[held]], len(mine)))
        shared = shared_counts(*sides)
        names, component = np.unique(labels, return_inverse=True)
        component, a, b = component.astype(np.int64), [], []
        root = np.arange(len(names))
        for i, x in enumerate(left):
            hits = right[scale * shared[i].astype(np.int64) >= g[x] + g[right] - base]
            own = root[component[x]]
            joined, first = np.unique(root[component[hits]], return_index=True)
            first, joined = first[joined != own], joined[joined != own]
            if len(joined):
                a += [int(nodes[x])] * len(joined)
                b += nodes[hits[first]].tolist()
                root[np.isin(root, joined)] = own
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return sides.groupBy("pivot", "p", "q").applyInArrow(links, "a long, b long").distinct()


def shared_counts(left: tuple, right: tuple) -> np.ndarray:
    """How many values rows i of left and j of right share. A side: values, the row of each, the number of rows.

    Values that many rows hold are counted by products of matrices, the others pair by pair of rows that hold them.
    """
    (x, of_x, n), (y, of_y, m) = left, right
    names = np.intersect1d(x, y)
    out = np.zeros((n, m), np.int32)
    if not len(names):
        return out

    def known(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(names, values), len(names) - 1)
        held = names[at] == values
        order = np.argsort(at[held], kind="stable")
        return at[held][order], rows[held][order]

    (cx, rx), (cy, ry) = known(x, of_x), known(y, of_y)
    in_x, in_y = np.bincount(cx, minlength=len(names)), np.bincount(cy, minlength=len(names))
    dense = in_x * in_y * 64 >= n * m
    column = np.cumsum(dense) - 1
    width = int(dense.sum())
    for at in range(0, width, 2048):
        parts = []
        for c, r, rows in ((cx, rx, n), (cy, ry, m)):
            mine = dense[c] & (column[c] >= at) & (column[c] < at + 2048)
            bits = np.zeros((rows, min(2048, width - at)), np.float32)
            bits[r[mine], column[c[mine]] - at] = 1
            parts.append(bits)
        out += (parts[0] @ parts[1].T).astype(np.int32)
    cx, rx = cx[~dense[cx]], rx[~dense[cx]]
    begin = np.cumsum(in_y) - in_y  # of a value's rows in ry
    until = np.cumsum(in_y[cx])
    flat, at = out.reshape(-1), 0
    while at < len(cx):
        to = max(at + 1, int(np.searchsorted(until, (until[at - 1] if at else 0) + (4 << 20), "right")))
        times = in_y[cx[at:to]]
        step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        np.add.at(flat, np.repeat(rx[at:to], times) * m + ry[np.repeat(begin[cx[at:to]], times) + step], 1)
        at = to
    return out


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, doc_id: str = "doc_id", text: str = "text", scratch: Scratch | None = None, own_ids: bool = False) -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of word shingles of at least percent / 100.

    1. Documents of equal sets are one class, a node from here on.
    2. Classes that share a band are candidates. In every bucket that has members of several components, all are compared
       with one pivot, first the member that shares most buckets with others: signatures, then full sets.
    3. In buckets that still have several components, members not far from the pivot are described by their differences
       from it. Pairs of them can be similar only if they share enough of these differences (see linkable); those pairs
       are compared on full sets. So no pair that could join two components goes without a comparison. Where most pairs
       of a group share differences they are counted for all its pairs, in tiles of bit matrices; its pairs never become
       rows, but the count itself is quadratic in such a group.
    4. Members far from the pivot get a pivot of their own in the next round. As the distance 1 - similarity is a metric, a
       similar pair is either near the pivot with both members or goes on with both. After ROUNDS rounds all that are
       left are described by their differences, however far.
    Links give components by large-star and small-star.

    Null, empty and blank texts have no set and are linked with nothing. Rows that share a doc_id are one document's, with
    the links of all their texts; a row without doc_id is linked with nothing and has no component. An empty table gives
    no rows. Extra columns are not read. Columns: doc_id, n_shingles, component_id, kept (doc_id = component_id; true
    without doc_id). The result is written in `scratch`; all other tables are deleted. own_ids: every row has a doc_id of its
    own, so texts are found by it alone, which moves none of a table that is laid out by it.
    """
    spark, scratch = docs.sparkSession, scratch or Scratch(docs.sparkSession, "minhash")
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn("text_hash", F.lit(0).cast("long") if own_ids else F.xxhash64("text"))
    signed = scratch.keep(signatures(source, shingle, bands, rows), "signed")
    with_set = signed.where("set_key is not null and doc_id is not null")
    grouped = with_set.groupBy("set_key").agg(F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.min("doc_id").alias("least"))
    # numbers of classes are in the order of their least doc_ids
    classes = scratch.keep(grouped.orderBy("least").select(F.monotonically_increasing_id().alias("node"), "set_key", "least", "rep.text_hash"), "classes")
    reps = with_set.join(classes.select("node", "set_key", F.col("least").alias("doc_id"), "text_hash"), ["doc_id", "set_key", "text_hash"])

    banded = reps.select("node", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("n")).where("lo <> hi").select("band", "n")
    live = scratch.keep(banded.join(shared, "band").distinct(), "in-buckets")
    ids = scratch.keep(live.groupBy("node").agg(F.sum("n").alias("weight")), "ids")
    live = scratch.keep(live.drop("n").join(ids, "node"), "live")
    scratch.drop("in-buckets")
    sketches = scratch.keep(reps.join(ids, "node", "left_semi").dropDuplicates(["node"]).select("node", "n_shingles", "sketch"), "sketches")
    wanted = classes.join(ids, "node", "left_semi").select("node", F.col("least").alias("doc_id"), "text_hash")
    near_texts = source.join(wanted.drop("text_hash"), "doc_id") if own_ids else source.join(wanted, ["doc_id", "text_hash"])
    texts = scratch.keep(near_texts.dropDuplicates(["node"]).select("node", "text"), "texts")
    # a doc_id of several texts joins their classes
    of_several = with_set.join(classes.select("node", "set_key"), "set_key").groupBy("doc_id").agg(F.min("node").alias("u"), F.collect_set("node").alias("nodes")).where("size(nodes) > 1")
    labels = Labels(scratch, of_several.select("u", F.explode("nodes").alias("v")))
    release(spark)

    q, hashes = percent / 100, bands * rows
    floor = q / 2  # of the similarity to the pivot, for a description by differences
    for step in range(ROUNDS + 1):
        marked = labels.put_on(live)
        # the pivot of a bucket: first the member that shares the most buckets with others, later one by chance
        order = F.col("weight") if not step else F.xxhash64("node", F.lit(step))
        sizes = marked.groupBy("band", "label").agg(F.max(F.struct(order.alias("o"), "node")).alias("top"))
        buckets = sizes.groupBy("band").agg(F.max("top.o").alias("o"), F.max_by(F.struct("top.node", "label"), "top").alias("pivot"), F.count("*").alias("labels")).where("labels > 1")
        mixed = scratch.keep(marked.join(buckets.select("band", "pivot"), "band"), f"mixed-{step}")
        scratch.drop(*([f"live-{step - 1}"] if step else ["live"]))
        if mixed.isEmpty():
            break
        last = step == ROUNDS
        pairs = mixed.where("node <> pivot.node").groupBy(F.col("pivot.node").alias("a"), F.col("node").alias("b")).agg(F.first(F.col("label") != F.col("pivot.label")).alias("apart"))
        pairs = scratch.keep(pairs, f"pairs-{step}")
        near = scratch.keep(equal_minima(pairs, sketches, 0 if last else floor, hashes), f"near-{step}")
        found = near.where(F.col("apart") & (F.col("same") >= least_equal(hashes, q))).where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
        labels.add(scratch.keep(confirmed(found.select("a", "b"), texts, percent, shingle), f"links-{step}"))
        release(spark)
        # what still has several components, by differences from the pivots
        marked = labels.put_on(mixed.drop("label"))
        open_bands = marked.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("band")
        still = scratch.keep(marked.join(open_bands, "band"), f"still-{step}")
        if still.isEmpty():
            break
        around = still.where("node <> pivot.node").select(F.col("pivot.node").alias("a"), F.col("node").alias("b")).distinct().join(near.select("a", "b"), ["a", "b"])
        described = scratch.keep(differences(around, texts, shingle), f"described-{step}")
        by_label = labels.put_on(described.select(F.col("a").alias("pivot"), F.col("b").alias("node"), "size", "lost", "added", "differences"))
        candidates = scratch.keep(linkable(by_label, percent, scratch, f"-{step}"), f"linkable-{step}")
        at_pivot = described.where(f"100 * (size - lost) >= {percent} * (size + added)").select("a", "b")
        labels.add(scratch.keep(confirmed(candidates, texts, percent, shingle).unionByName(at_pivot), f"links-by-differences-{step}"))
        release(spark)
        if last:
            break
        close = described.where(F.col("size") - F.col("lost") >= (floor + 1 - q) * (F.col("size") + F.col("added"))).select(F.col("a").alias("pivot_node"), F.col("b").alias("node"))
        far = still.where("node <> pivot.node").withColumn("pivot_node", F.col("pivot.node")).join(close, ["pivot_node", "node"], "left_anti")
        live = scratch.keep(far.select("band", "node", "weight"), f"live-{step}")
        scratch.drop(*(f"{x}-{step}" for x in ("mixed", "pairs", "near", "still", "described", "ranked", "crowded", "linkable")))

    leasts = classes.select(F.col("node").alias("label"), F.col("least").alias("component"))
    moved = labels.put_on(classes.select("node", "set_key", "least")).where("label <> node").join(leasts, "label").select("set_key", "component")
    of_class = classes.join(moved, "set_key", "left").select("set_key", F.coalesce("component", "least").alias("component"))
    found = signed.select("doc_id", "n_shingles", "set_key").join(of_class, "set_key", "left")
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component")), F.col("doc_id"))
    found = found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
    out = scratch.keep(found, "found")
    scratch.clear("found")
    release(spark)
    return out


class Labels:
    """The component of every node so far; a node without links is its own."""

    def __init__(self, scratch: Scratch, links: DataFrame):
        self.scratch, self.step, self.table = scratch, 0, None
        joined = connected_components(links, scratch, "cc-0")
        self.table = scratch.keep(joined, "labels-0")

    def put_on(self, rows: DataFrame, node: str = "node", label: str = "label") -> DataFrame:
        """rows with the label of a column of nodes."""
        found = self.table.select(F.col("node").alias(node), F.col("label").alias("found"))
        return rows.join(found, node, "left").withColumn(label, F.coalesce("found", node)).drop("found")

    def add(self, links: DataFrame) -> None:
        """Join the components of rows a, b, a written table."""
        if links.isEmpty():
            return
        self.step += 1
        lifted = self.put_on(self.put_on(links, "a", "u"), "b", "v").select("u", "v")
        joined = self.scratch.keep(connected_components(lifted, self.scratch, f"cc-{self.step}"), "joined").select("node", F.col("label").alias("to"))
        moved = self.table.join(joined.select(F.col("node").alias("label"), "to"), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        found = moved.unionByName(joined.join(self.table, "node", "left_anti").select("node", F.col("to").alias("label")))
        self.table = self.scratch.keep(found, f"labels-{self.step}")
        self.scratch.drop(f"labels-{self.step - 1}")
