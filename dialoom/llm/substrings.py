"""Removal of byte strings that occur more than once, by blockwise suffix sorting with a cover sample."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .minhash import mix
from .shared import Scratch, release, text_array

#: Bytes of the strings that the cover sample is drawn by.
GRAM = 32
#: Longer texts are sampled in segments that overlap by all but one byte of a string.
SEGMENT = 2 << 20
POSITION_BITS = 23
#: Runs of a bucket that are sorted at once; a larger bucket is split by its next bytes first.
AT_ONCE = 1000
#: Parts that the distances of such a bucket are cut into: three rounds come from all distances to single ones.
SHARES = 8
#: Suffixes of a bucket that are compared pair by pair; larger buckets are sorted.
FEW = 6

BYTE_HASHES = np.random.default_rng(7).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sample_cover(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """The cover sample of the segments buffer[start:end]: in every string of `width` bytes, the place of the GRAM bytes with the least hash.

    Equal strings have it at the same place, so this is a difference cover that depends on the content alone. Gives
    runs of strings with one sample place: first start, last start, place, hash.
    """
    n = len(buffer)
    empty = (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    long_enough = ends - starts >= width
    starts, ends = starts[long_enough], ends[long_enough]
    if not len(starts):
        return empty
    hashes, span = BYTE_HASHES[buffer], 1
    while span < GRAM:
        hashes = hashes[:-span] * np.uint64(0x9E3779B97F4A7C15 + 2 * span) + hashes[span:]
        hashes ^= hashes >> np.uint64(29)
        span *= 2
    hashes = mix(hashes)
    place_bits = np.uint64((1 << POSITION_BITS) - 1)
    least = (hashes & ~place_bits) | np.arange(len(hashes), dtype=np.uint64)
    grams, span = width - GRAM + 1, 1
    while 2 * span <= grams:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if grams > span:
        least = np.minimum(least[: len(least) - (grams - span)], least[grams - span :])
    change = np.zeros(n + 1, np.int8)
    change[starts] += 1
    change[ends - width + 1] -= 1
    at = np.flatnonzero(np.cumsum(change[: len(least)]))
    place = (least[at] & place_bits).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return at[first], at[last], place[first], hashes[place[first]]


def runs_of_batch(batch: pa.RecordBatch, width: int) -> Iterator[pa.RecordBatch]:
    texts = text_array(batch.column("text"))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.empty(0, np.uint8)
    ids = batch.column("row_id").to_numpy()
    parts: list[tuple[int, int, int]] = []

    def emit(parts):
        base, top = parts[0][1], parts[-1][2]
        starts, ends = (np.array([p[i] for p in parts], np.int64) - base for i in (1, 2))
        buffer = data[base:top]
        lo, hi, place, h = sample_cover(buffer, starts, ends, width)
        raw = buffer.tobytes()
        contexts = b"".join(hashlib.blake2b(raw[a : b + width], digest_size=8, salt=(p - a).to_bytes(2, "little")).digest() for a, b, p in zip(lo.tolist(), hi.tolist(), place.tolist(), strict=True))
        row = np.array([p[0] for p in parts], np.int64)[np.searchsorted(starts, lo, side="right") - 1]
        origin = offsets[row] - base
        columns = [h.view(np.int64), np.frombuffer(contexts, np.int64), ids[row], lo - origin, (hi - lo + 1).astype(np.int32), (place - lo).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "context", "row_id", "lo", "n", "anchor"])

    for row in range(len(texts)):
        start, end = int(offsets[row]), int(offsets[row + 1])
        while end - start >= width:
            stop = min(end, start + SEGMENT)
            if parts and (stop - parts[0][1] > SEGMENT or start < parts[-1][2]):
                yield emit(parts)
                parts = []
            parts.append((row, start, stop))
            start = stop - width + 1 if stop < end else end
    if parts:
        yield emit(parts)


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def repeated_in_bucket(members: list[tuple[int, int, int, bytes]], width: int) -> list[list[tuple[int, int]]]:
    """members: (n, anchor, first start, bytes) of the runs of one sample hash. For each, the intervals of its starts whose strings another run also has.

    The string that starts d bytes before a member's sample place is its left context of d bytes, then the suffix at that
    place. The suffixes are ranked first; strings are then ordered by their left contexts, with ties resolved by those
    ranks, one distance d at a time.
    """
    rights = [body[anchor:] for _, anchor, _, body in members]
    lefts = [body[:anchor][::-1] for _, anchor, _, body in members]
    found: list[list[tuple[int, int]]] = [[] for _ in members]
    far = [anchor for _, anchor, _, _ in members]  # of the first start
    near = [anchor - n + 1 for n, anchor, _, _ in members]
    if len(members) <= FEW:
        for i in range(len(members)):
            for j in range(i):
                least = max(near[i], near[j], width - common(rights[i], rights[j]))
                most = min(far[i], far[j])
                if least <= most and (most := min(most, common(lefts[i], lefts[j]))) >= least:
                    for k in (i, j):
                        found[k].append((members[k][2] + far[k] - most, members[k][2] + far[k] - least))
        return found
    m = len(members)
    distances = np.arange(min(near), max(far) + 1)

    def classes(strings: list[bytes], depths: np.ndarray) -> np.ndarray:
        """(m, depths): equal numbers for strings with equal prefixes of that depth."""
        order = sorted(range(m), key=strings.__getitem__)
        shared = np.array([common(strings[a], strings[b]) for a, b in zip(order, order[1:], strict=False)])
        out = np.zeros((m, len(depths)), np.int64)
        out[order[1:]] = np.cumsum(shared[:, None] < depths[None, :], axis=0)
        return out

    key = classes(rights, width - distances) * m + classes(lefts, distances)
    inside = (distances[None, :] >= np.array(near)[:, None]) & (distances[None, :] <= np.array(far)[:, None])
    key = np.where(inside, key, -1 - np.arange(m)[:, None])
    order = np.argsort(key, axis=0, kind="stable")
    ranked = np.take_along_axis(key, order, axis=0)
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros((m, len(distances)), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = np.zeros_like(twice)
    np.put_along_axis(hit, order, twice, axis=0)
    for i in np.flatnonzero(hit.any(axis=1)).tolist():
        d = distances[hit[i]]
        breaks = np.flatnonzero(np.diff(d) > 1)
        for a, b in zip(d[np.append(0, breaks + 1)].tolist(), d[np.append(breaks, len(d) - 1)].tolist(), strict=True):
            found[i].append((members[i][2] + far[i] - b, members[i][2] + far[i] - a))
    return found


#: Rows of a bucket's runs. near, far: the distances from a string's start to the sample place that the bucket has.
PART = "h long, row_id long, lo long, n int, anchor int, body binary, near int, far int"
PART_TYPES = {"h": pa.int64(), "row_id": pa.int64(), "lo": pa.int64(), "n": pa.int32(), "anchor": pa.int32(), "body": pa.binary(), "near": pa.int32(), "far": pa.int32()}


def body_rows(rows: list[tuple], types: dict = PART_TYPES) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], names=list(types))


def shares(row: tuple, width: int) -> Iterator[tuple]:
    """A run's starts by the share of the bucket's distances that they are in, each with the bucket that they go to and a digest of all their bytes.

    All strings whose starts are near to far bytes before the sample place have the bytes from the nearest start to the
    farthest one's end in common, so equal strings go to one bucket. A bucket of one distance holds equal strings alone.
    """
    h, row_id, lo, n, anchor, body, near, far = row
    step = -(-(far - near + 1) // SHARES)
    for p in range(near, far + 1, step):
        q = min(p + step - 1, far)
        first, last = min(anchor, q), max(anchor - n + 1, p)
        if first < last:
            continue
        skip = anchor - first
        mine = body[skip : skip + first - last + width]
        core = hashlib.blake2b(mine[first - p : first - q + width], digest_size=8, key=h.to_bytes(8, "little", signed=True), salt=p.to_bytes(4, "little")).digest()
        context = hashlib.blake2b(mine, digest_size=16, salt=first.to_bytes(4, "little")).digest()
        yield int.from_bytes(core, "little", signed=True), row_id, lo + skip, first - last + 1, first, mine, p, q, context


def shares_by(width: int):
    types = PART_TYPES | {"context": pa.binary()}

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, AT_ONCE):
                few = batch.slice(start, AT_ONCE)
                rows = zip(*(few.column(c).to_pylist() for c in PART_TYPES), strict=True)
                yield body_rows([x for row in rows for x in shares(row, width)], types)

    return run


def merged(intervals: list[tuple[int, int]], width: int) -> list[tuple[int, int]]:
    """Intervals of starts as maximal spans of bytes [start, end)."""
    out: list[list[int]] = []
    for lo, hi in sorted(intervals):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi + width)
        else:
            out.append([lo, hi + width])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, width: int = 200, doc_id: str = "doc_id", text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """Every document without the bytes that are covered by a string of `width` bytes that also starts anywhere else.

    Every string of `width` bytes belongs to one suffix of the cover sample, by its content alone. Suffixes are dealt
    into buckets by the sample's hash and each bucket is sorted by itself; a bucket whose runs are all equal, such as
    one of whole copies, is settled by counts. A bucket of over AT_ONCE unequal runs is split by the bytes around the
    sample place until its parts are small or equal, so no task sorts more than AT_ONCE runs. Strings never cross documents, and are
    judged on the input.

    Null texts are empty. Shorter texts keep all. Repeated rows repeat each other's strings. Rows may share a doc_id or
    have none. An empty table gives no rows. Other columns, whatever their names, come back in the struct `rest`.
    Columns: doc_id, text (the kept bytes; what is left of a character cut in two is left out of it), n_bytes, n_removed,
    spans (array<struct<start, end>> of removed bytes), kept_sha256, rest.
    """
    if width < 2 * GRAM:
        raise ValueError(f"width is at least {2 * GRAM}")
    spark, scratch = docs.sparkSession, scratch or Scratch(docs.sparkSession, "substrings")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (doc_id, text)]
    rest = F.struct(*others) if others else F.lit(None).cast("struct<none:int>")
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), rest.alias("rest"))
    # one table with row numbers, laid out by them: what joins it later moves to the texts, not the texts to it
    texts = scratch.keep_bucketed(rows, "row_id", "texts")

    def sample(batches):
        from .shared import sliced

        for batch in sliced(batches, "text", SEGMENT):
            yield from runs_of_batch(batch, width)

    runs = scratch.keep(texts.select("row_id", "text").mapInArrow(sample, "h long, context long, row_id long, lo long, n int, anchor int"), "runs")
    repeated = runs.groupBy("h").agg(F.count("*").alias("size"), F.min("context").alias("x"), F.max("context").alias("y")).where("size > 1")
    repeated = scratch.keep(repeated.select("h", (F.col("x") == F.col("y")).alias("equal")), "repeated")
    release(spark)
    candidates = scratch.keep(runs.join(repeated, "h"), "candidates")
    scratch.drop("runs")
    release(spark)
    unequal = candidates.where("not equal")
    # runs of one context are whole repeats; one of them stands for the others from here on
    contexts = unequal.groupBy("h", "context").agg(F.count("*").alias("copies"), F.min(F.struct("row_id", "lo", "n", "anchor")).alias("run"))
    contexts = scratch.keep(contexts, "contexts")
    whole = candidates.where("equal").unionByName(unequal.join(contexts.where("copies > 1").select("h", "context"), ["h", "context"]).select(candidates.columns))
    whole = whole.select("row_id", "lo", (F.col("lo") + F.col("n") - 1).alias("hi"))
    shown_runs = contexts.groupBy(F.col("run.row_id").alias("row_id")).agg(F.collect_list(F.struct("h", "run.lo", "run.n", "run.anchor")).alias("runs"))

    def bodies(batches):
        for batch in batches:
            out = []
            data = text_array(batch.column("text")).to_pylist()
            for row, body, found in zip(batch.column("row_id").to_pylist(), data, batch.column("runs").to_pylist(), strict=True):
                out += [(r["h"], row, r["lo"], r["n"], r["anchor"], body[r["lo"] : r["lo"] + r["n"] - 1 + width], 0, width - GRAM) for r in found]
                if len(out) > 20_000:
                    yield body_rows(out)
                    out = []
            yield body_rows(out)

    shown = scratch.keep(texts.select("row_id", "text").join(shown_runs, "row_id").mapInArrow(bodies, PART), "shown")
    release(spark)

    # large buckets: the shares of the distances from the sample place, each dealt anew by the bytes that its strings have in common
    small, split, repeats, level = [], [], [], 0
    while True:
        large = scratch.keep(shown.groupBy("h").count().where(F.col("count") > AT_ONCE).select("h"), f"large-{level}")
        if large.isEmpty():
            small.append(shown)
            break
        small.append(shown.join(large, "h", "left_anti"))
        parts = scratch.keep(shown.join(large, "h", "left_semi").mapInArrow(shares_by(width), f"{PART}, context binary"), f"parts-{level}")
        alike = parts.groupBy("h", "context").agg(F.count("*").alias("copies"), F.min(F.struct("row_id", "lo", "n", "anchor", "body", "near", "far")).alias("run"))
        alike = scratch.keep(alike, f"alike-{level}")
        split.append(parts.select("h", "context", "row_id", "lo", "n"))
        repeats.append(alike.where("copies > 1").select("h", "context"))
        several = alike.groupBy("h").agg(F.count("*").alias("contexts")).where("contexts > 1").select("h")
        level += 1
        shown = scratch.keep(alike.join(several, "h", "left_semi").select("h", "run.*"), f"shown-{level}")
        release(spark)

    def sort_buckets(batches):
        current, members = None, []

        def close(out):
            if len(members) > 1:
                for (_, row, *_), found in zip(members, repeated_in_bucket([m[2:] for m in members], width), strict=True):
                    out.extend((row, lo, hi) for lo, hi in found)

        def rows_of(out):
            columns = zip(*out, strict=True) if out else ([], [], [])
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["row_id", "lo", "hi"])

        for batch in batches:
            out: list = []
            for h, row, lo, n, anchor, body in zip(*(batch.column(c).to_pylist() for c in ("h", "row_id", "lo", "n", "anchor", "body")), strict=True):
                if h != current:
                    close(out)
                    current, members = h, []
                members.append((h, row, n, anchor, lo, body))
            yield rows_of(out)
        out = []
        close(out)
        yield rows_of(out)

    # the parts of all rounds at once, as each round costs a step for every partition; buckets of two rounds have other hashes
    every = lambda tables: functools.reduce(DataFrame.unionByName, tables)
    settled = [whole, every([t.select("h", "row_id", "lo", "n", "anchor", "body") for t in small]).repartition("h").sortWithinPartitions("h").mapInArrow(sort_buckets, "row_id long, lo long, hi long")]
    if split:
        settled.append(every(split).join(every(repeats), ["h", "context"]).select("row_id", "lo", (F.col("lo") + F.col("n") - 1).alias("hi")))
    intervals = every(settled).groupBy("row_id").agg(F.collect_list(F.struct("lo", "hi")).alias("intervals"))
    intervals = scratch.keep(intervals, "intervals")
    scratch.clear("texts", "intervals")
    release(spark)
    with_intervals = texts.join(intervals, "row_id", "left").select("doc_id", "text", "rest", "intervals")

    def cut(batches):
        from .shared import sliced

        for batch in sliced(batches, "text", 8 << 20):
            out = {"text": [], "n_bytes": [], "n_removed": [], "spans": [], "kept_sha256": []}
            for body, found in zip(text_array(batch.column("text")).to_pylist(), batch.column("intervals").to_pylist(), strict=True):
                spans = merged([(x["lo"], x["hi"]) for x in found or ()], width)
                kept, at = [], 0
                for a, b in spans:
                    kept.append(body[at:a])
                    at = b
                kept_bytes = b"".join([*kept, body[at:]])
                out["text"].append(kept_bytes.decode("utf-8", "ignore") if spans else body.decode("utf-8", "replace"))
                out["n_bytes"].append(len(body))
                out["n_removed"].append(len(body) - len(kept_bytes))
                out["spans"].append([{"start": a, "end": b} for a, b in spans])
                out["kept_sha256"].append(hashlib.sha256(kept_bytes).hexdigest())
            types = {"text": pa.string(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), "kept_sha256": pa.string()}
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(out[c], t) for c, t in types.items()), batch.column("rest")], names=["doc_id", *types, "rest"])

    scratch.forget("texts")
    kinds = dict(with_intervals.dtypes)
    return with_intervals.mapInArrow(cut, f"doc_id {kinds['doc_id']}, text string, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept_sha256 string, rest {kinds['rest']}")
