"""Best-fit decreasing packing of tokenised documents into sequences."""

from __future__ import annotations

import os
import zlib
from functools import lru_cache
from unicodedata import is_normalized

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, LongType

from .shared import Scratch, map_arrow

END_ID = 0
CAPACITY = 2048
#: Words in the younger of the two halves of what a worker remembers.
CACHE_WORDS = 400_000
STOPS = b".,;:!?"
#: Parts that pieces are numbered in, besides one for each length. Bounds what the driver collects.
PARTS = 4096


#: Texts of many kinds of words and of what is between them, to see if a tokenizer takes words one by one.
PROBES = ["Plain words, UPPER Case it's don't", "two  spaces", "a  a", "tab\ttab", "line\nline", "\n\n x ", "12 3.14 1,000 a-b_c (x) [y] <z>", "é ÀÉ ｆｕｌｌ 漢字 かな … ... !!", "http://a.b/c?d=e&f x\u0301 \u00a0 end", "Ends, don't. it's; é, 7. x!? y.., z\u0301, (a), 's.", "unbelievable straße élève größenwahn señorita naïveté λόγος слово 語彙 ﬁx ǆ ª º"]


def byte_names() -> dict[int, str]:
    """The characters that byte-level tokenizers write bytes with: printable ones of Latin-1 as they are, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


BYTE_NAMES = byte_names()


class CapacityTree:
    """A segment tree over remaining capacities: the least capacity of at least n that some open bin has."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.size)

    def mark(self, capacity: int, is_open: bool) -> None:
        i = capacity + self.size
        self.open[i] = is_open
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        i = least + self.size
        if self.open[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                break
            i //= 2
        else:
            return None
        while i < self.size:
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.size


def plan_best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best-fit decreasing for a multiset of lengths, given as length -> count.

    Bins of equal remaining capacity are interchangeable, so they are moved in runs: the plan has rows (length, rank,
    bin, count, offset): the pieces of that length with ranks rank..rank+count-1 go to bins bin..bin+count-1 at that
    offset. Its size depends on the lengths that occur, not on how many pieces there are. Also gives the number of bins.
    """
    tree, spans, plan, bins = CapacityTree(capacity), {}, [], 0

    def put(room: int, start: int, n: int) -> None:
        if room and n:
            if not spans.get(room):
                tree.mark(room, True)
            spans.setdefault(room, []).append((start, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0

        def fill(start: int, n: int, room: int, each: int) -> None:
            nonlocal rank, left
            for j in range(each):
                plan.append((length, rank, start, n, capacity - room + j * length))
                rank += n
            left -= n * each
            put(room - each * length, start, n)

        while left:
            room = tree.tightest(length)
            if room is None:
                each = capacity // length
                if n := left // each:
                    bins += n
                    fill(bins - n, n, capacity, each)
                else:
                    bins += 1
                    fill(bins - 1, 1, capacity, left)
                continue
            start, n = spans[room].pop()
            if not spans[room]:
                tree.mark(room, False)
            each = room // length
            if take := min(n, left // each):
                put(room, start + take, n - take)
                fill(start, take, room, each)
            else:
                put(room, start + 1, n - 1)
                fill(start, 1, room, left)
    return plan, bins


class Memory(dict):
    """The ids of words that were met, each encoded when it is first asked for. The older half is forgotten when the younger is full, but for words in use.

    Stops at a word's end are symbols, so after a letter they are looked up by themselves.
    """

    def __init__(self, ids_of):
        super().__init__()
        self.ids_of, self.old = ids_of, {}

    def __missing__(self, word: bytes) -> bytes:
        found = self.old.get(word)
        if found is None:
            stem = word.rstrip(STOPS)
            if len(stem) < len(word) and stem and 97 <= stem[-1] <= 122:
                found = self[stem] + self[word[len(stem) :]]
            else:
                found = self.ids_of(word.decode("utf-8"))
        self[word] = found
        return found

    def settle(self) -> None:
        if len(self) > CACHE_WORDS:
            self.old = dict(self)
            self.clear()


@lru_cache(maxsize=2)
def word_encoder(tokenizer_file: str):
    """text -> the ids of its words as little-endian unsigned 32-bit integers.

    A pre-tokenizer that never matches across a space, tab or line feed lets a text be cut there into words that can be
    encoded, and remembered, one by one; one that takes runs of letters whole and names bytes lets plain words go to the merges at
    once. A tokenizer for which that does not give the ids of some fixed texts is used in the plainer way, at last for whole texts.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from array import array

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file)
    ids_of = lambda text: array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
    merges = tokenizer.model

    def ids_of_word(text: str) -> bytes:
        # letters that are lower case and composed already: neither normaliser nor pre-tokenizer has anything to do but to name the bytes
        if text.isalpha() and text == text.lower() and is_normalized("NFC", text):
            return array("I", [t.id for t in merges.tokenize(text.encode().decode("latin-1").translate(BYTE_NAMES))]).tobytes()
        return ids_of(text)

    def encode(texts: list[str]) -> list[bytes]:
        memory.settle()
        # what may hold a special token is left to the tokenizer as it is; else A-Z, which it lowers too, is lowered here
        return [ids_of(t) if "<|" in t else b"".join(map(memory.__getitem__, words_of(t))) for t in texts]

    words_of = lambda text: text.encode("utf-8", "replace").lower().replace(b"\n", b" ").replace(b"\t", b" ").split(b" ")
    for each in (ids_of_word, ids_of):  # the first that gives what the tokenizer gives for whole texts
        memory = Memory(each)
        if all(b"".join(map(memory.__getitem__, words_of(text))) == ids_of(text) for text in PROBES):
            return encode
    return lambda texts: [ids_of(t) for t in texts]


def tokenised_pieces(docs: DataFrame, tokenizer_file: str, capacity: int, doc_id: str, text: str) -> DataFrame:
    """Rows of doc_id, piece, start, length, ids_crc32: each document's ids and END_ID, cut where longer than capacity."""
    end, step = END_ID.to_bytes(4, "little"), 4 * capacity

    def cut(batch: pa.RecordBatch) -> dict:
        out = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
        ids = batch.column("doc_id").to_pylist()
        for key, data in zip(ids, word_encoder(tokenizer_file)([t or "" for t in batch.column("text").to_pylist()]), strict=True):
            data += end
            for piece, at in enumerate(range(0, len(data), step)):
                body = data[at : at + step]
                out["doc_id"].append(key)
                out["piece"].append(piece)
                out["start"].append(at // 4)
                out["length"].append(len(body) // 4)
                out["ids_crc32"].append(zlib.crc32(body))
        return out

    return map_arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), cut, "doc_id long, piece int, start long, length long, ids_crc32 long", most=4 << 20)


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The place of every piece of every document in sequences of at most `capacity` tokens.

    Best-fit decreasing runs once over the counts of lengths (at most `capacity` of them), which is all that the driver
    needs; pieces then find their place by their rank among those of their length. Ranks are numbered in parts
    by rows, so a length that most pieces have is not one task, nor are rows of one doc_id or without one.

    Null and empty texts are a single END_ID. Repeated rows are packed each. Ties in length go by doc_id and piece. An
    empty table gives no rows. Extra columns are not read.
    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "packing")
    pieces = scratch.keep(tokenised_pieces(docs, tokenizer_file, capacity, doc_id, text).withColumn("row_id", F.monotonically_increasing_id()), "pieces")
    counts = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}
    per_part = max(256, -(-sum(counts.values()) // PARTS))
    parts_of = spark.createDataFrame([(n, -(-c // per_part)) for n, c in counts.items()], "length long, parts long")
    pieces = pieces.join(F.broadcast(parts_of), "length").withColumn("part", F.pmod(F.xxhash64("row_id"), F.col("parts"))).drop("parts", "row_id")

    starts, seen = [], {}
    for r in sorted(pieces.groupBy("length", "part").count().collect(), key=lambda r: (r.length, r.part)):
        starts.append((r.length, r.part, seen.get(r.length, 0)))
        seen[r.length] = seen.get(r.length, 0) + r["count"]
    first = spark.createDataFrame(starts, "length long, part long, first long")
    order = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("row", F.row_number().over(order)).join(F.broadcast(first), ["length", "part"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("row") - 1).alias("rank"))

    plan, _ = plan_best_fit(counts, capacity)
    runs = spark.sparkContext.broadcast(sorted(plan))
    kind = StructType([*(f for f in ranked.schema if f.name != "rank"), StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def place(batches):
        import numpy as np

        table = np.array(runs.value, dtype=np.int64).reshape(-1, 5)
        far = np.int64(1) << 44
        keys = table[:, 0] * far + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, length * far + rank, side="right") - 1
            found = table[at]
            columns = [batch.column(f.name) for f in kind if f.name in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found[:, 2] + rank - found[:, 1]), pa.array(found[:, 4])], names=[f.name for f in kind])

    return ranked.mapInArrow(place, kind)
