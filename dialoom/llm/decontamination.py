"""Benchmark passages in documents, by q-gram filtering and banded alignment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, map_arrow, sliced

#: A probe is a window of so many characters of a passage, cut every STRIDE; shorter passages are one probe.
PROBE, STRIDE = 100, 50
#: Passages shorter than this are compared by short q-grams, and have to begin and end where a word does.
SHORT = 40
#: Edits that an alignment of a probe has at most, as a share of its length.
EDITS = 0.08
#: Length of the q-grams, and of those of short passages. A probe of n characters within e edits shares at least n + 1 - q * (e + 1) of them.
Q, SHORT_Q = 9, 4
TABLE_BITS = 22
#: No character's code.
NOTHING = 0xFFFFFFFF
#: Characters of benchmark text that one worker holds as an index; a larger benchmark is searched in so many passes.
INDEX_CHARS = 8_000_000


def normal(text: str | None) -> str:
    """Lower case, with single spaces."""
    return " ".join((text or "").lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(chars: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of every q-gram."""
    n = len(chars) - q + 1
    if n < 1:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    wide = chars.astype(np.uint64)
    for i in range(q):
        out = out * np.uint64(0x9E3779B97F4A7C15) + wide[i : i + n]
    return out ^ (out >> np.uint64(31))


def distinct_sorted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of a sorted array, and where each begins."""
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return values[starts], starts


@dataclass
class Probe:
    item: int
    start: int  # in the normalised passage
    text: str
    edits: int
    shared: int  # q-grams that an alignment within `edits` has at least


def indexes(items: list[tuple[int, str]]) -> list[Index]:
    """Passages by the length of the q-grams that they are found by; those shorter than SHORT_Q are one q-gram each."""
    by_length: dict[int, list] = {}
    for item, text in items:
        if text:
            by_length.setdefault(Q if len(text) >= SHORT else min(SHORT_Q, len(text)), []).append((item, text))
    return [Index(found, q) for q, found in sorted(by_length.items())]


class Index:
    """The q-grams of all probes of some passages."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q):
        self.q = q
        self.probes: list[Probe] = []
        for item, text in items:
            starts = [0] if len(text) <= PROBE else [*range(0, len(text) - PROBE, STRIDE), len(text) - PROBE]
            for at in starts:
                part = text[at : at + PROBE]
                edits = int(len(part) * EDITS)
                self.probes.append(Probe(item, at, part, edits, max(1, len(part) + 1 - q * (edits + 1))))
        grams = [gram_hashes(codes(p.text), q) for p in self.probes]
        of = np.repeat(np.arange(len(grams)), [len(g) for g in grams]) if grams else np.empty(0, np.int64)
        at = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.empty(0, np.int64)
        hashes = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.of, self.at = hashes[order], of[order], at[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
        self.least = min((p.shared for p in self.probes), default=1)
        self.widest = max((len(p.text) + 2 * p.edits for p in self.probes), default=1)
        self.shared = np.array([p.shared for p in self.probes], np.int64)
        self.edits = np.array([p.edits for p in self.probes], np.int64)

    def regions(self, chars: np.ndarray) -> Iterator[tuple[int, int]]:
        """(probe, diagonal) of the diagonal bands that share enough q-grams with a probe."""
        hashes = gram_hashes(chars, self.q)
        hit = np.flatnonzero(self.table[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
        if len(hit) < self.least:
            return
        # hits that lie in no stretch as wide as an alignment with enough others are in no region
        ahead = np.searchsorted(hit, hit + self.widest) - np.arange(len(hit))
        dense = np.zeros(len(hit) + 1, np.int64)
        good = np.flatnonzero(ahead >= self.least)
        np.add.at(dense, good, 1)
        np.add.at(dense, good + ahead[good], -1)
        hit = hit[np.cumsum(dense[:-1]) > 0]
        if not len(hit):
            return
        first = np.searchsorted(self.hashes, hashes[hit], side="left")
        n = np.searchsorted(self.hashes, hashes[hit], side="right") - first
        position = np.repeat(hit, n)
        entry = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(len(position))
        probe, diagonal = self.of[entry], position - self.at[entry]
        if not len(probe):
            return
        # overlapping bands: every band of 2e + 1 diagonals lies in one of the two that a diagonal is counted in
        band = (diagonal + 2 * PROBE) // (2 * self.edits[probe] + 1)  # not negative
        far = np.int64(1) << 32
        keys = np.concatenate([probe * far + band, probe * far + band - 1])
        order = np.argsort(keys, kind="stable")
        found, starts = distinct_sorted(keys[order])
        counts = np.diff(np.append(starts, len(keys)))
        enough = np.flatnonzero(counts >= self.shared[found // far])
        # a gram of the probe counts once in a band, however often the text repeats it there
        at = self.at[np.tile(entry, 2)[order]]
        enough = [k for k in enough.tolist() if len(set(at[starts[k] : starts[k] + counts[k]].tolist())) >= self.shared[found[k] // far]]
        for key in found[enough].tolist():
            p, b = divmod(key, int(far))
            half = 2 * int(self.edits[p]) + 1
            yield p, b * half - 2 * PROBE  # the band's least diagonal


def aligned(probe: str, text: str, edits: int) -> tuple[int, int] | None:
    """Banded alignment: the end in text and the distance of the best place of the whole probe, if within `edits`.

    Rows are the probe's characters. The text has `edits` characters that match nothing put on both sides, so column j of
    row i is text[i + j - edits], and a probe with characters missing has its diagonals where the text begins or ends too.
    """
    width = max(1, len(text) - len(probe) + 1 + 2 * edits)
    t, p = np.full(width + len(probe) - 1, NOTHING, np.uint32), codes(probe)
    t[edits : edits + len(text)] = codes(text)
    steps = np.arange(width)
    row = np.zeros(width, np.int64)  # the alignment may start at any diagonal of the band
    for i in range(len(p)):
        best = row + (t[i : i + width] != p[i])
        best[:-1] = np.minimum(best[:-1], row[1:] + 1)
        row = np.minimum.accumulate(best - steps) + steps
        if i >= edits and row.min() > edits:
            return None
    at = int(row.argmin())
    return (min(max(0, len(probe) + at - edits), len(text)), int(row[at])) if row[at] <= edits else None


def at_words(body: str, start: int, end: int, edits: int) -> bool:
    """Whether a place begins and ends where words do, give or take its edits."""
    inside = lambda i: 0 < i < len(body) and body[i - 1].isalnum() and body[i].isalnum()
    near = range(-edits, edits + 1)
    return not all(inside(start + k) for k in near) and not all(inside(end + k) for k in near)


def leaks_in(text: str, found_by: list[Index]) -> dict[int, tuple[int, int, int, int]]:
    """item -> start and end in the normalised text of its first and last leak, number of places of leaked probes, least edits."""
    body = normal(text)
    found: dict[int, tuple[int, int, int, int]] = {}
    if not body:
        return found
    chars = codes(body)
    for index in found_by:
        reached: dict[int, int] = {}  # where a probe's last place ends
        for p, diagonal in index.regions(chars):
            probe = index.probes[p]
            half = 2 * probe.edits + 1
            if diagonal + half - 1 + len(probe.text) <= reached.get(p, -1) + probe.edits:
                continue  # the same place, in the next band
            start = max(0, diagonal)
            place = aligned(probe.text, body[start : max(start, diagonal + 2 * half + len(probe.text))], probe.edits)
            if place is None:
                continue
            end, distance = start + place[0], place[1]
            first = max(0, end - len(probe.text))
            if index.q < Q and not at_words(body, first, end, probe.edits):
                continue
            again = end <= reached.get(p, -1)
            reached[p] = max(end, reached.get(p, -1))
            a, b, n, d = found.get(probe.item, (first, end, 0, distance))
            found[probe.item] = (min(a, first), max(b, end), n + (not again), min(d, distance))
    return found


def benchmark_items(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """The normalised passages in lots of at most INDEX_CHARS characters (or one longer passage), which bounds what is broadcast."""
    lot, size = [], 0
    source = benchmark.select(F.col(item_id).cast("long").alias("item"), F.col(text).alias("text")).where("item is not null and text is not null")
    for r in source.orderBy("item", "text").toLocalIterator():
        body = normal(r.text)
        if lot and size + len(body) > INDEX_CHARS:
            yield lot
            lot, size = [], 0
        lot.append((r.item, body))
        size += len(body)
    if lot:
        yield lot


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Documents that hold a passage of a benchmark, or a probe of it, within the edit budget.

    Texts are compared in lower case with single spaces. Each probe of a passage that shares enough q-grams with a band
    of diagonals of a document (q-gram lemma, so no alignment within the budget is missed) is aligned in that band.
    The index of a lot of passages goes to every worker, and documents are never moved; a benchmark of more than
    INDEX_CHARS characters is searched lot by lot.

    Passages shorter than SHORT are found between words only, with few edits or none. Null and empty texts hold nothing; empty
    and null passages and those without item_id are not searched for. Repeated documents are each a row; equal passages are each found. Empty tables give no rows. Extra columns are
    not read. Columns: doc_id, item_id, start, end (characters of the normalised text, from the first leak to the last), probes
    (places of leaked ones), edits (least).
    """
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, item_id long, start long, end long, probes int, edits int"
    out = None
    for lot in benchmark_items(benchmark, item_id, item_text):
        shared = spark.sparkContext.broadcast(lot)
        held: dict = {}

        def run(batch: pa.RecordBatch, shared=shared, held=held) -> dict:
            if "index" not in held:
                held["index"] = indexes(shared.value)
            rows = []
            for key, body in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for item, (a, b, n, d) in sorted(leaks_in(body, held["index"]).items()):
                    rows.append((key, item, a, b, n, d))
            columns = zip(*rows, strict=True) if rows else ([],) * 6
            return dict(zip(("doc_id", "item_id", "start", "end", "probes", "edits"), columns, strict=True))

        found = map_arrow(source, run, schema)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs in which no passage is found; all columns as they were. Decided row by row, so a row without doc_id is judged by its text too.

    A benchmark of several lots is searched lot by lot, with what is left written in between, so a worker holds one index.
    """
    scratch, kept, n = Scratch(docs.sparkSession, "decontamination"), docs, 0
    for lot in benchmark_items(benchmark, "item_id", "text"):
        kept = scratch.keep(kept, f"kept-{n}") if n else kept
        kept, n = kept.mapInArrow(clean_of(docs.sparkSession.sparkContext.broadcast(lot), text), docs.schema), n + 1
        if n > 2:
            scratch.drop(f"kept-{n - 2}")
    return kept


def clean_of(lot, text: str):
    held: dict = {}

    def run(batches):
        if "index" not in held:
            held["index"] = indexes(lot.value)
        for batch in sliced(batches, text):
            yield batch.filter(pa.array([not leaks_in(body, held["index"]) for body in batch.column(text).to_pylist()], pa.bool_()))

    return run
