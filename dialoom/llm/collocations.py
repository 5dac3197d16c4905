"""Collocations of words, mined level by level."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import SLICE_BYTES, Scratch, sliced, text_array

#: Bits of a bitmap for each frequent phrase, about, and in all at most (32 MB).
BITS_EACH, MOST_BITS = 16, 1 << 28
#: Rows of a language that the last ranking has in one task, at most, times what is wanted.
BUCKETS = 64

BLANKS, STOPS = b" \t", b".,;:!?\n\x0b\x0c\r"
STOP = re.compile(b"[.,;:!?\n-\r]")
KIND = np.zeros(256, np.uint8)  # 0: in a word
KIND[list(BLANKS)], KIND[list(STOPS)] = 1, 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
MIX, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
BYTE_HASH = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
COUNTS = "lang string, phrase string, n long"


def hashes(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash of each of some byte strings."""
    offsets, data = buffers_of(strings)
    lengths = np.diff(offsets)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(lengths.max(initial=0)) + 1, MIX))
        inside = np.arange(len(data)) - np.repeat(offsets[:-1], lengths)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_HASH[data] * powers[inside])])
        return sums[offsets[1:]] - sums[offsets[:-1]] + lengths.astype(np.uint64)


def stirred(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * STEP
        return h ^ (h >> np.uint64(29))


def buffers_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0, and the bytes, of a LargeBinaryArray."""
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = strings.buffers()[2]
    return offsets - offsets[0], np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)


class Words:
    """The words of some texts in order: for each one its number in `words`, its piece, and its language's number in `langs`."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        offsets, data = buffers_of(texts)
        kind, lower = KIND[data], LOWER[data]
        inside = kind == 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        first = offsets[:-1][np.diff(offsets) > 0]  # first bytes of texts that are not empty
        begins[first] = inside[first]
        starts = np.flatnonzero(begins)
        lengths = np.add.reduceat(inside.astype(np.int64), starts) if len(starts) else starts  # up to the next word's start
        of_text = np.searchsorted(offsets, starts, side="right") - 1
        self.piece = np.cumsum(kind == 2)[starts] + of_text  # both only grow, so it is the same only if both are
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])
        tokens = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(lower[inside].tobytes())])
        coded, spoken = tokens.dictionary_encode(), langs.dictionary_encode()
        self.words, self.word = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        self.langs, self.lang = spoken.dictionary, spoken.indices.to_numpy().astype(np.int64)[of_text]

    def within(self, k: int) -> np.ndarray:
        """Whether k words from a place are in one piece, for places that have so many words after them."""
        n = max(0, len(self.word) - k + 1)
        return self.piece[:n] == self.piece[k - 1 : k - 1 + n]

    def places(self, k: int, bits: int) -> np.ndarray:
        """The bit of each phrase of k words (and its language) in a bitmap of so many bits."""
        n = max(0, len(self.word) - k + 1)
        own = hashes(self.words)[self.word]
        with np.errstate(over="ignore"):
            h = stirred(hashes(self.langs))[self.lang[:n]]
            for j in range(k):
                h = stirred(h) * MIX + own[j : j + n]
        return (stirred(h) & np.uint64(bits - 1)).astype(np.int64)

    def counted(self, at: np.ndarray, k: int) -> pa.RecordBatch:
        """Phrases of k words that begin at some places, each once with its count; they are told apart exactly."""
        code, size = self.lang[at], max(1, len(self.words))
        for j in range(k):
            code = code * size + self.word[at + j]
            code = pa.array(code).dictionary_encode().indices.to_numpy().astype(np.int64)  # numbers of phrases so far, so the next product is small
        counts = np.bincount(code) if len(code) else np.zeros(0, np.int64)
        one = np.zeros(len(counts), np.int64)
        one[code] = at
        words = [self.words.take(pa.array(self.word[one + j])) for j in range(k)]
        phrase = words[0] if k == 1 else pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary()))
        return pa.RecordBatch.from_arrays([self.langs.take(pa.array(self.lang[one])).cast(pa.string()), phrase.cast(pa.large_string()).cast(pa.string()), pa.array(counts.astype(np.int64))], names=["lang", "phrase", "n"])


def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """Words of batches (text, lang), about SLICE_BYTES at a time. A longer text is cut after pieces, which no phrase goes beyond."""
    for batch in sliced(batches, "text"):
        texts, langs = text_array(batch.column("text")), batch.column("lang").cast(pa.large_string()).cast(pa.large_binary())
        if batch.num_rows > 1 or len(texts) and pc.binary_length(texts)[0].as_py() <= SLICE_BYTES:
            yield Words(texts, langs)
            continue
        data, at = texts[0].as_py(), 0
        while at < len(data):
            stop = STOP.search(data, at + SLICE_BYTES)
            end = stop.end() if stop else len(data)
            yield Words(pa.array([data[at:end]], pa.large_binary()), langs)
            at = end


def counted_words(source: DataFrame) -> DataFrame:
    """Occurrences of every word by language; the row of a language without phrase has that of all words."""

    def count(batches):
        for words in parts_of(batches):
            yield words.counted(np.arange(len(words.word)), 1)
            spoken = np.bincount(words.lang, minlength=len(words.langs))
            yield pa.RecordBatch.from_arrays([words.langs.cast(pa.string()), pa.nulls(len(spoken), pa.string()), pa.array(spoken.astype(np.int64))], names=["lang", "phrase", "n"])

    return source.mapInArrow(count, COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def bitmap(level: DataFrame, k: int) -> tuple[np.ndarray, int]:
    """Frequent phrases of k words as a bitmap of their hashes, and its bits.

    The table can be of any size; the bitmap is bounded. Where it is too small for its table, more phrases seem frequent
    than are: the next level then counts more of them, and its counts, which are exact, decide.
    """
    n = level.count()
    bits = min(MOST_BITS, 1 << max(15, (BITS_EACH * n).bit_length()))

    def places(batches):
        for batch in batches:
            words = Words(text_array(batch.column("phrase")), batch.column("lang").cast(pa.large_string()).cast(pa.large_binary()))
            first = np.flatnonzero(np.diff(words.piece, prepend=-1))  # a phrase is a text of one piece
            yield pa.RecordBatch.from_arrays([pa.array(words.places(k, bits)[first] + 1)], names=["at"])

    at = level.select("phrase", "lang").mapInArrow(places, "at long")
    parts = at.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).toArrow()
    out = np.zeros(bits // 8, np.uint8)
    for bucket, found in zip(parts.column("bucket").to_pylist(), parts.column("bits").to_pylist(), strict=True):
        out[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(found, np.uint8)[: bits // 8]
    return out, bits


def counted_phrases(source: DataFrame, below: DataFrame, k: int) -> DataFrame:
    """Occurrences of phrases of k words by language, of those only whose first and last k - 1 words are frequent."""
    frequent, bits = bitmap(below, k - 1)
    shared = source.sparkSession.sparkContext.broadcast(frequent)

    def count(batches):
        known = shared.value
        for words in parts_of(batches):
            at = words.places(k - 1, bits)
            good = words.within(k - 1) & ((known[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)
            starts = np.flatnonzero(words.within(k) & good[:-1] & good[1:])
            if len(starts):
                yield words.counted(starts, k)

    return source.mapInArrow(count, COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def part(words: str, begin: str, length: str):
    return F.array_join(F.slice(F.col(words), F.expr(begin), F.expr(length)), " ")


def find_collocations(docs: DataFrame, longest: int = 5, least: int = 100, factor: int = 1000, share: int = 100, top: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """The `top` phrases of each language by how much more often their parts stand together than by chance.

    Level by level, phrases of k words are counted where both phrases of k - 1 words in them occur `least` times; these are
    broadcast as a bitmap of bounded size. A worker counts what it has read by exact codes before rows are made. A phrase is cut after
    k words into parts of l and r occurrences, with score floor(factor * a * n / (l * r)); its worst cut counts, of equal ones the first.
    Phrases inside a longer one that has at least `share` percent of their occurrences are dropped: if a longer one does, then so does
    one of a single word more, so levels are compared with the next one only. Of each language a hash of the phrase deals
    candidates into parts that are cut to the `top` ranks before they meet.

    A null text is empty; a null language is und. Repeated rows count each. A piece between stops is taken whole, however
    long. An empty table, or one without a frequent phrase, gives no rows. Other columns are not read, whatever their names.
    Columns: lang, rank, phrase, a, l, r, n, score.
    """
    scratch = Scratch(docs.sparkSession, "phrases")
    source = docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    first = scratch.keep(counted_words(source).where(F.col("phrase").isNull() | (F.col("n") >= least)), "level-1")
    total = first.where("phrase is null").select("lang", F.col("n").alias("all"))
    levels = [first.where("phrase is not null")]
    for k in range(2, longest + 1):
        levels.append(scratch.keep(counted_phrases(source, levels[-1], k).where(F.col("n") >= least), f"level-{k}"))
    counts = reduce(DataFrame.unionByName, levels)
    phrases = reduce(DataFrame.unionByName, levels[1:], levels[0].limit(0)).withColumn("words", F.split("phrase", " "))

    longer = phrases.where(F.size("words") > 2)
    ends = longer.select("lang", F.explode(F.array(part("words", "1", "size(words) - 1"), part("words", "2", "size(words) - 1"))).alias("phrase"), "n")
    held = ends.groupBy("lang", "phrase").agg(F.max("n").alias("held"))
    kept = phrases.join(held, ["lang", "phrase"], "left").where(F.col("held").isNull() | (100 * F.col("held") < share * F.col("n"))).join(total, "lang")

    cuts = kept.select("lang", "phrase", F.col("n").alias("a"), F.col("all").alias("n"), "words", F.explode(F.expr("sequence(1, size(words) - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "n", "k", part("words", "1", "k").alias("first"), part("words", "k + 1", "size(words) - k").alias("rest"))
    sides = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"]).join(counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    wide = lambda c: f"cast({c} as decimal(19, 0))"  # noqa: E731  products of two have 38 digits
    scored = sides.withColumn("score", F.expr(f"cast({factor} as decimal(38, 0)) * ({wide('a')} * {wide('n')}) div ({wide('l')} * {wide('r')})"))
    worst = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("w"))
    rows = worst.select("lang", "phrase", "w.a", "w.l", "w.r", "w.n", "w.score")

    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS)))
    few = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("rank") <= top)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
