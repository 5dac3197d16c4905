"""Toxic texts by a subsequence string-kernel support vector machine with Nyström landmarks."""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, sliced

#: Labelled rows that a model is fitted on, of each label, at most about; drawn by a hash of doc_id.
SAMPLE_ROWS = 6_000
#: A subsequence has so many letters and spans at most so many; besides, every other letter of a longer stretch.
LETTERS, SPAN = 4, 6
#: A subsequence that spans n letters weighs DECAY**n.
DECAY = 0.7
BUCKETS = 1 << 20
#: Letters of a sentence in which the subsequences of one string begin; a longer sentence has a string at every letter.
WIDTH = 16
LANDMARKS = 250  # strings of each label that the kernel is approximated by
#: Times that the strings of the labelled texts are chosen anew by the machine learned before.
ROUNDS = 4
#: Standard deviations by which a subsequence is commoner in toxic texts, to point to the first examples.
SURPRISE = 3.0
COST = 1.0  # of a training string on the wrong side of its margin
#: Letters whose subsequences are in memory at once.
CHUNK = 1 << 15
#: Bytes of texts that a worker scores at once.
SLICE = 1 << 18
#: Between words; sentences begin and end with it too.
MARK = "_"
#: What ends a sentence.
ENDS = ".!?…。！？\n\r\x0b\x0c\x85  "
TEXT_END = "\x03"
LETTER, SENTENCE_END, DOCUMENT_END = 1, 2, 3

PATTERNS = [(0, *rest) for rest in combinations(range(1, SPAN), LETTERS - 1)] + [tuple(range(0, 2 * LETTERS, 2))]
REACH = max(p[-1] for p in PATTERNS)
LENGTH = (WIDTH * sum(DECAY ** (2 * (p[-1] + 1)) for p in PATTERNS)) ** 0.5
FACTORS = np.random.default_rng(88).integers(1, 2**63, LETTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFT = np.uint64(64 - BUCKETS.bit_length() + 1)


class Kinds:
    """What every code point is; made once in each worker."""

    table: np.ndarray | None = None

    @classmethod
    def of(cls, codes: np.ndarray) -> np.ndarray:
        if cls.table is None:
            table = np.fromiter(map(str.isalpha, map(chr, range(0x110000))), np.uint8, 0x110000)
            table[[ord(c) for c in ENDS]] = SENTENCE_END
            table[ord(TEXT_END)] = DOCUMENT_END
            cls.table = table
        return cls.table[codes]


@dataclass
class Letters:
    """The letters of some texts in lower case, with one mark between words and one at the ends of every sentence."""

    codes: np.ndarray
    end: np.ndarray  # whether a letter is the mark at the ends of sentences
    text: np.ndarray  # the number of the letter's text

    @classmethod
    def of(cls, texts: list[str | None]) -> Letters:
        joined = TEXT_END + TEXT_END.join((t or "").replace(TEXT_END, " ") for t in texts).lower() + TEXT_END
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = Kinds.of(codes)
        letter = kind == LETTER
        text = np.cumsum(kind == DOCUMENT_END, dtype=np.int32) - 1
        first = ~letter
        first[1:] &= letter[:-1]  # of a run of other characters
        runs = np.flatnonzero(first)
        strongest = np.maximum.reduceat(np.where(letter, 0, kind), runs)  # the run at the start has the first text's end
        keep = letter | first
        # a mark between two texts opens the later one; it is the last mark of the earlier one as well
        last = np.append(np.flatnonzero(letter[1:] & ~letter[:-1]), len(codes) - 1)
        end = np.zeros(len(codes), bool)
        end[runs] = strongest >= SENTENCE_END
        out = np.where(letter, codes, ord(MARK))
        number = text.copy()
        number[runs] = np.where(strongest == DOCUMENT_END, text[np.minimum(last + 1, len(text) - 1)], text[runs])
        joins = np.zeros(len(codes), bool)  # a single point joins letters as well as spaces do
        joins[runs] = (strongest == 0) | (strongest == SENTENCE_END) & (last == runs)
        out, end, number, letter, joins = out[keep], end[keep], number[keep], letter[keep], joins[keep]
        # words of one letter in a row are one word
        alone = np.zeros(len(out), bool)
        alone[1:-1] = letter[1:-1] & ~letter[:-2] & ~letter[2:]
        between = np.zeros(len(out), bool)
        between[1:-1] = joins[1:-1] & alone[:-2] & alone[2:]
        spaced = between.copy()  # three such words at least
        wide = np.concatenate([[False, False], between, [False, False]])
        spaced &= wide[:-4] | wide[4:]
        return cls(out[~spaced], end[~spaced], number[~spaced])

    def sentence_ends(self) -> np.ndarray:
        """For every letter the place of the mark that ends its sentence; a mark belongs to the sentence that it opens."""
        ends = np.flatnonzero(self.end)
        following = np.searchsorted(ends, np.arange(len(self.codes)), side="right")
        return np.append(ends, len(self.codes) - 1)[following]


def buckets(hashed: list[np.ndarray], offsets: tuple[int, ...], first: int, last: int) -> np.ndarray:
    """The buckets of the subsequences of one pattern that begin at first, ..., last - 1."""
    total = hashed[0][first:last].copy()
    for h, o in zip(hashed[1:], offsets[1:], strict=True):
        total += h[first + o : last + o]
    total >>= SHIFT
    return total.view(np.int64)


def hashed_letters(codes: np.ndarray) -> list[np.ndarray]:
    wide = np.append(codes, np.zeros(REACH, codes.dtype)).astype(np.uint64)
    wide = (wide + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    wide ^= wide >> np.uint64(29)
    return [wide * k for k in FACTORS]


def features(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Subsequences of strings that begin in their first WIDTH letters: the number of each one's string, its bucket and its weight.

    Weights are divided by the length that those of a whole string have if all are different, so that a short sentence counts
    like the same letters in a long one.
    """
    lengths = np.array([len(s) for s in strings], np.int64)
    codes = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
    string = np.repeat(np.arange(len(strings)), lengths)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    left = lengths[string] - place
    hashed = hashed_letters(codes)
    of, at, weight = [], [], []
    for offsets in PATTERNS:
        start = np.flatnonzero((left > offsets[-1]) & (place < WIDTH))
        of.append(string[start])
        at.append(buckets(hashed, offsets, 0, len(codes))[start])
        weight.append(np.full(len(start), DECAY ** (offsets[-1] + 1) / LENGTH))
    return np.concatenate(of), np.concatenate(at), np.concatenate(weight)


def kernel_with(strings: list[str], landmarks: list[str]) -> np.ndarray:
    """(strings, landmarks): the subsequence kernel."""
    blocks = []
    for first in range(0, len(landmarks), 64):
        part = landmarks[first : first + 64]
        of, at, weight = features(part)
        known, place = np.unique(at, return_inverse=True)
        table = np.zeros((len(known), len(part)), np.float32)
        np.add.at(table, (place, of), weight)
        blocks.append((first, known, table))
    out = np.zeros((len(strings), len(landmarks)), np.float32)
    for begin in range(0, len(strings), 500):
        of, at, weight = features(strings[begin : begin + 500])
        order = np.argsort(of, kind="stable")
        of, at, weight = of[order], at[order], weight[order].astype(np.float32)
        for first, known, table in blocks:
            row = np.minimum(np.searchsorted(known, at), len(known) - 1)
            seen = known[row] == at
            mine = of[seen]
            if len(mine):
                starts = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
                out[begin + mine[starts], first : first + table.shape[1]] = np.add.reduceat(table[row[seen]] * weight[seen, None], starts, axis=0)
    return out


def support_vectors(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 30) -> np.ndarray:
    """A linear support vector machine (squared hinge, L2) by finite Newton steps: ridge regression on the rows inside the margin, until they stay the same. The last weight is the bias."""
    n, width = x.shape
    weights, inside = np.zeros(width + 1), np.ones(n, bool)
    for _ in range(rounds):
        gram, side = np.eye(width + 1) * 0.5, np.zeros(width + 1)
        rows = np.flatnonzero(inside)
        for first in range(0, len(rows), 2000):
            at = rows[first : first + 2000]
            part = np.hstack([x[at], np.ones((len(at), 1))]).astype(np.float64)
            weighted = part * cost[at, None]
            gram += part.T @ weighted
            side += weighted.T @ y[at]
        target = np.linalg.solve(gram, side)
        weights = target if not weights.any() else 0.3 * weights + 0.7 * target
        now = y * (x @ weights[:-1] + weights[-1]) < 1
        if (now == inside).all():
            break
        inside = now
    return weights


@dataclass
class ToxicityModel:
    keys: np.ndarray  # buckets of the subsequences that weigh something, in order
    values: np.ndarray  # their weights, summed over landmarks
    bias: float
    slope: float = 4.0  # of the logistic curve from margin to score
    middle: float = 0.0

    def table(self) -> np.ndarray:
        found = self.__dict__.get("_table")
        if found is None:
            found = self.__dict__["_table"] = np.zeros(BUCKETS, np.float32)
            found[self.keys] = self.values
        return found

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_table"}

    def margins(self, letters: Letters) -> tuple[np.ndarray, np.ndarray]:
        """Where the strings of sentences begin, and their margins.

        A string's subsequences are those of its sentence that begin in its WIDTH letters. A shorter sentence is one string.
        """
        n, table = len(letters.codes), self.table()
        ends = letters.sentence_ends()
        value = np.zeros(n + 1)
        for first in range(0, n, CHUNK):
            last = min(n, first + CHUNK)
            room = ends[first:last] - np.arange(first, last)
            hashed = hashed_letters(letters.codes[first : last + REACH])
            total = np.zeros(last - first, np.float32)
            for reach in sorted({p[-1] for p in PATTERNS}):
                mine = [p for p in PATTERNS if p[-1] == reach]
                part = table[buckets(hashed, mine[0], 0, last - first)]
                for p in mine[1:]:
                    part += table[buckets(hashed, p, 0, last - first)]
                part[room < reach] = 0
                part *= np.float32(DECAY ** (reach + 1) / LENGTH)
                total += part
            value[first + 1 : last + 1] = total
        value = np.cumsum(value)
        at = np.arange(n)
        starts = np.flatnonzero((at + WIDTH <= ends) | letters.end)
        stops = np.minimum(starts + WIDTH, ends[starts])
        return starts, value[stops] - value[starts] + self.bias

    def best(self, texts: list[str | None]) -> tuple[np.ndarray, list[str]]:
        """The margin of each text's most toxic string, and that string."""
        letters = Letters.of(texts)
        starts, margins = self.margins(letters)
        ends = letters.sentence_ends()
        out, strings = np.full(len(texts), self.bias), [""] * len(texts)
        if len(starts):
            of = letters.text[starts]
            begins = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            for a, b in zip(begins.tolist(), np.append(begins[1:], len(of)).tolist(), strict=True):
                i, k = int(of[a]), a + int(margins[a:b].argmax())
                if i < len(texts):
                    s = int(starts[k])
                    out[i] = max(self.bias, float(margins[k])) if ends[s] - s > 1 else self.bias
                    strings[i] = "".join(map(chr, letters.codes[s : min(int(ends[s]) + 1, s + WIDTH + REACH)].tolist()))
        return out, strings

    def score_margins(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (margins - self.middle), -50, 50)))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        letters = Letters.of(texts)
        starts, margins = self.margins(letters)
        out = np.full(len(texts) + 1, self.bias)
        if len(starts):
            of = letters.text[starts]
            begins = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            np.maximum.at(out, of[begins], np.maximum.reduceat(margins, begins))
        return self.score_margins(out[: len(texts)])


def nothing() -> ToxicityModel:
    return ToxicityModel(np.empty(0, np.int64), np.empty(0, np.float32), -1.0)


def fit_strings(positive: list[str], negative: list[str]) -> ToxicityModel:
    """The machine for strings: Nyström features of landmarks, folded back into one weight for each subsequence."""
    draw = np.random.default_rng(8)
    pick = lambda strings: [strings[i] for i in sorted(draw.permutation(len(strings))[:LANDMARKS].tolist())]
    landmarks = list(dict.fromkeys(pick(positive) + pick(negative)))
    values, vectors = np.linalg.eigh(kernel_with(landmarks, landmarks).astype(np.float64))
    good = values > 1e-4 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    y = np.array([1.0] * len(positive) + [-1.0] * len(negative))
    found = support_vectors(kernel_with(positive + negative, landmarks) @ root.astype(np.float32), y, np.where(y > 0, COST * max(1.0, len(negative) / len(positive)) ** 0.5, COST))
    beta = root @ found[:-1]
    of, at, weight = features(landmarks)
    keys, place = np.unique(at, return_inverse=True)
    return ToxicityModel(keys, np.bincount(place, weight * beta[of], len(keys)).astype(np.float32), float(found[-1]))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """A model of the docs that labels call 0 or 1, from about sample_rows of each label, whole texts.

    The sample is drawn from the labels by a hash, so only its ids, which are few by that bound, go to the texts. Rows
    of several labels count with each. A label is one of a text; it holds for its sentences like this: all strings of all
    sentences of a clean text are clean, and one sentence at least of a toxic text is toxic. The machine learns from a
    toxic text's most toxic string, and from those strings of clean texts that score highest, chosen anew in every round
    by the machine of the round before; the first choice is by the subsequences that toxic texts have oftener than
    clean ones. Without both labels nothing is toxic.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    rows = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("toxic")).distinct()
    counts = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not (counts.get(0) and counts.get(1)):
        return nothing()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1 << 30))
    bound = {k: int(min(1.0, sample_rows / n) * (1 << 30)) for k, n in counts.items()}
    drawn = scratch.keep(rows.where(draw < F.when(F.col("toxic") == 1, bound[1]).otherwise(bound[0])), "drawn")
    texts = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sample = scratch.keep(texts.join(F.broadcast(drawn), "doc_id").select("text", "toxic"), "sample")
    n = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not (n.get(0) and n.get(1)):
        return nothing()

    # how much oftener texts of the sample have a subsequence if they are toxic, in standard deviations
    share = (F.col("bad") + F.col("good")) / F.lit(n[0] + n[1])
    gap = (F.col("bad") / F.lit(n[1]) - F.col("good") / F.lit(n[0])) / F.sqrt(share * (1 - share) * F.lit(1 / n[0] + 1 / n[1]))
    odds = F.log((F.col("bad") + 0.5) / F.lit(n[1] + 1)) - F.log((F.col("good") + 0.5) / F.lit(n[0] + 1))
    presence = sample.mapInArrow(count_subsequences, "bucket long, bad long, good long").groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    telling = presence.where((share < 1) & (gap >= SURPRISE) & (odds > 0)).select("bucket", odds.alias("odds")).orderBy("bucket").toPandas()
    model = ToxicityModel(telling.bucket.to_numpy(np.int64), telling.odds.to_numpy(np.float32), 0.0)

    def choose(model: ToxicityModel) -> tuple[list, list]:
        shared = spark.sparkContext.broadcast(model)

        def run(batches):
            for batch in sliced(batches, most=SLICE):
                margins, strings = shared.value.best(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(margins), pa.array(strings, pa.string())], names=["toxic", "margin", "string"])

        found = sample.mapInArrow(run, "toxic int, margin double, string string").collect()
        shared.destroy()
        return tuple([(r.string, r.margin) for r in sorted(found, key=lambda r: (-r.margin, r.string)) if r.toxic == k] for k in (0, 1))

    clean, toxic = choose(model)
    positive = [s for s, margin in toxic if margin > 0]
    negative = list(dict.fromkeys(s for s, _ in clean))
    for turn in range(ROUNDS):
        if not positive or not negative:
            scratch.drop("drawn", "sample")
            return nothing()
        model = fit_strings(positive, negative)
        clean, toxic = choose(model)
        if turn + 1 < ROUNDS:
            chosen = [s for s, margin in toxic if margin > -1] or positive
            chosen_set = set(chosen)
            # what the machine is sure of is no counter-example that it needs
            more = [s for s, margin in clean if margin > -1]
            positive, negative = chosen, [s for s in dict.fromkeys(negative + more) if s not in chosen_set]
    scratch.drop("drawn", "sample")

    # the score is one half where it parts the texts of the sample best
    good, bad = (np.sort(np.array([margin for _, margin in side])) for side in (clean, toxic))
    cuts = np.unique(np.concatenate([bad, good]))
    cuts = (cuts[1:] + cuts[:-1]) / 2 if len(cuts) > 1 else cuts
    # weighed as the labels have them, not as the sample has
    wrong = np.searchsorted(bad, cuts) * (counts[1] / max(1, len(bad))) + (len(good) - np.searchsorted(good, cuts)) * (counts[0] / max(1, len(good)))
    best = cuts[wrong <= wrong.min() + 1e-9]
    model.middle = max(float(best[0] + best[-1]) / 2, math.nextafter(model.bias, math.inf))
    return model


def count_subsequences(batches):
    """Texts of a partition that have each subsequence without gaps, by label."""
    found = np.zeros((2, BUCKETS), np.int32)
    for batch in sliced(batches, most=SLICE):
        letters = Letters.of(batch.column("text").to_pylist())
        if len(letters.codes) < LETTERS:
            continue
        toxic = batch.column("toxic").to_numpy()
        fits = letters.sentence_ends() - np.arange(len(letters.codes)) >= PATTERNS[0][-1]
        at = buckets(hashed_letters(letters.codes), PATTERNS[0], 0, len(letters.codes))[fits]
        pairs = np.unique(letters.text[fits].astype(np.int64) * BUCKETS + at)
        for k in (0, 1):
            found[k] += np.bincount(pairs[toxic[pairs // BUCKETS] == k] % BUCKETS, minlength=BUCKETS).astype(np.int32)
    at = np.flatnonzero(found.any(axis=0))
    for first in range(0, len(at), 1 << 16):
        part = at[first : first + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(found[1, part].astype(np.int64)), pa.array(found[0, part].astype(np.int64))], names=["bucket", "bad", "good"])


def score_texts(docs: DataFrame, model: ToxicityModel, text: str = "text", score: str = "score") -> DataFrame:
    """The rows of docs with a score from 0 to 1 as one more column (instead of one of that name).

    A text scores as its most toxic string: WIDTH letters of one sentence, across words, from every letter on. Words of
    one letter in a row are read as one word. Whole texts are scored, however long. Null, empty and letterless texts score
    as strings without subsequences, which is low. Repeated rows are each a row. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in docs.columns if c != score]
    source = docs.select(*(F.col(f"`{c}`") for c in columns))

    def run(batches):
        for batch in sliced(batches, text, SLICE):
            found = shared.value.scores(batch.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*columns, score])

    from pyspark.sql.types import DoubleType, StructType

    return source.mapInArrow(run, StructType([*source.schema.fields]).add(score, DoubleType()))
