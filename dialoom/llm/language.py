"""Language of texts: scripts narrow the candidates, Viterbi over word scores labels spans."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .minhash import Vocabulary, mix
from .shared import map_arrow, sliced

#: Labelled rows that a model is fitted on, at most about; drawn by a hash of doc_id.
SAMPLE_ROWS = 16_000
BUCKETS = 1 << 15
ORDERS = (1, 2, 3, 4)
#: Score that a change of language between two words costs.
SWITCH = 6.0
#: Score that a word has at least, compared with its best language.
FLOOR = -12.0
#: Share of a language's letters that a script has at least to be one of its scripts.
SCRIPT_SHARE = 0.02
#: Words whose scores a worker remembers; the memory starts anew when it is full.
CACHE_WORDS = 400_000
UNKNOWN = "und"

# First code points of the Unicode blocks of scripts, and the script from there on.
SCRIPTS = np.array(
    [
        (0x0000, 0), (0x0041, 1), (0x02B0, 0), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 7), (0x0750, 6), (0x0780, 8), (0x07C0, 9),
        (0x08A0, 6), (0x0900, 10), (0x0980, 11), (0x0A00, 12), (0x0A80, 13), (0x0B00, 14), (0x0B80, 15), (0x0C00, 16), (0x0C80, 17), (0x0D00, 18), (0x0D80, 19),
        (0x0E00, 20), (0x0E80, 21), (0x0F00, 22), (0x1000, 23), (0x10A0, 24), (0x1100, 25), (0x1200, 26), (0x13A0, 27), (0x1400, 28), (0x1780, 29), (0x1800, 30),
        (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3040, 31), (0x30A0, 32), (0x3100, 33), (0x3130, 25), (0x3190, 0), (0x3400, 34), (0xA000, 35), (0xAC00, 25),
        (0xD7B0, 0), (0xF900, 34), (0xFB00, 1), (0xFB1D, 5), (0xFB50, 6), (0xFE00, 0), (0x20000, 34), (0x30000, 0),
    ],
    np.int64,
)
N_SCRIPTS = int(SCRIPTS[:, 1].max()) + 1
EDGE = "\x02"
NO_LETTER = re.compile(r"[\W\d_]+")


def letters_of(word: str) -> str:
    """The letters of a word in lower case."""
    return word.lower() if word.isalpha() else NO_LETTER.sub("", word).lower()


def script_of(codes: np.ndarray) -> np.ndarray:
    return SCRIPTS[np.searchsorted(SCRIPTS[:, 0], codes, side="right") - 1, 1]


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of words with marked ends: the number of each one's word, and its bucket."""
    codes = np.frombuffer((EDGE + EDGE.join(words) + EDGE).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    edge = codes == 2
    word = np.cumsum(edge) - 1  # an edge belongs to the word that begins there
    all_words, all_buckets = [], []
    hashes = np.zeros(len(codes), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        hashes = hashes[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :]
        if n not in ORDERS:
            continue
        inner = np.zeros(len(hashes), bool)
        for i in range(1, n - 1):
            inner |= edge[i : i + len(hashes)]
        first, last = edge[: len(hashes)], edge[n - 1 :]
        good = ~inner & ~(first & last) if n > 1 else ~first
        all_words.append(word[: len(hashes)][good])
        all_buckets.append((mix(hashes[good] + np.uint64(n)) >> np.uint64(49)).astype(np.int64))
    return np.concatenate(all_words), np.concatenate(all_buckets)


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # (BUCKETS, languages): log probabilities, less their mean over languages
    scripts: np.ndarray  # (N_SCRIPTS, languages): whether the language is written in the script

    def word_scores(self, words: list[str]) -> np.ndarray:
        """(words, languages): how much each word speaks for each language; 0 for words without letters."""
        out = np.zeros((len(words), len(self.languages)), np.float32)
        some = [i for i, w in enumerate(words) if w]
        if not some or not self.languages:
            return out
        found = [words[i] for i in some]
        of, buckets = grams_of(found)
        scores = np.stack([np.bincount(of, self.weights[buckets, k], len(found)) for k in range(len(self.languages))], axis=1) / len(ORDERS)
        script = script_of(np.frombuffer("".join(w[0] for w in found).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64))
        allowed = self.scripts[script]
        # a script that no language has narrows nothing
        allowed = allowed | ~allowed.any(axis=1, keepdims=True)
        scores = np.where(allowed, scores, -np.inf)
        best = scores.max(axis=1, keepdims=True)
        out[some] = np.maximum(scores - best, FLOOR)
        return out


def fit(labelled: DataFrame, doc_id: str, text: str, lang: str, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Letter n-gram model of the languages of rows with text and lang, from about sample_rows of them, whole texts."""
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    n = rows.select("doc_id", "lang").count()
    if n > sample_rows:
        rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(1 << 30)) < int(sample_rows / n * (1 << 30)))

    def count(batches):
        totals: dict = {}
        for batch in sliced(batches):
            for lang_here in set(batch.column("lang").to_pylist()):
                texts = batch.filter(pc.equal(batch.column("lang"), lang_here)).column("text").to_pylist()
                words = [w for t in texts for x in t.split() if (w := letters_of(x))]
                if words:
                    grams, scripts = totals.setdefault(lang_here, (np.zeros(BUCKETS, np.int64), np.zeros(N_SCRIPTS, np.int64)))
                    grams += np.bincount(grams_of(words)[1], minlength=BUCKETS)
                    scripts += np.bincount(script_of(np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)), minlength=N_SCRIPTS)
        for lang_here, counted in totals.items():
            for base, values in zip((0, BUCKETS), counted, strict=True):
                at = np.flatnonzero(values)
                yield pa.RecordBatch.from_arrays([pa.array([lang_here] * len(at), pa.string()), pa.array(at + base), pa.array(values[at])], names=["lang", "key", "n"])

    counted = rows.mapInArrow(count, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counted.lang.unique())
    grams, scripts = np.zeros((BUCKETS, len(languages))), np.zeros((N_SCRIPTS, len(languages)))
    for k, name in enumerate(languages):
        mine = counted[counted.lang == name]
        small = mine.key < BUCKETS
        grams[mine.key[small], k] = mine.n[small]
        scripts[mine.key[~small] - BUCKETS, k] = mine.n[~small]
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros((N_SCRIPTS, 0), bool))
    logs = np.log((grams + 0.5) / (grams + 0.5).sum(axis=0))
    shares = scripts / np.maximum(scripts.sum(axis=0), 1)
    return LanguageModel(languages, (logs - logs.mean(axis=1, keepdims=True)).astype(np.float32), shares >= SCRIPT_SHARE)


def best_paths(scores: np.ndarray, lengths: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Viterbi over many texts at once: the language of every word. scores: (words, languages), text after text.

    Texts are taken longest first, so at each step those that still have a word are the first ones.
    """
    n_words, n_langs = scores.shape
    out = np.zeros(n_words, np.int64)
    if not n_words or n_langs < 2:
        return out
    order = np.argsort(-lengths, kind="stable")
    begin = (np.cumsum(lengths) - lengths)[order]
    alive = np.searchsorted(-lengths[order], -np.arange(lengths.max()), side="left")  # texts with more than t words
    came = np.zeros((n_words, n_langs), np.uint8 if n_langs <= 256 else np.int32)
    own = np.arange(n_langs, dtype=came.dtype)
    total = np.zeros((len(lengths), n_langs), np.float64)
    for t in range(int(lengths.max())):
        d = alive[t]
        now = total[:d]
        if t:
            best = now.argmax(axis=1)
            changed = now[np.arange(d), best][:, None] - switch
            stays = now >= changed
            came[begin[:d] + t] = np.where(stays, own, best[:, None])
            now = np.where(stays, now, changed)
        total[:d] = now + scores[begin[:d] + t]
    state = total.argmax(axis=1)
    for t in range(int(lengths.max()) - 1, -1, -1):
        d = alive[t]
        at = begin[:d] + t
        out[at] = state[:d]
        state[:d] = came[at, state[:d]] if t else state[:d]
    return out


class Labeller:
    """Words of texts and the language of each, for one worker."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.words, self.scores, self.letters = Vocabulary(), np.empty((0, len(self.model.languages)), np.float32), np.empty(0, np.int64)

    def label(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text the language of every word, and the number of its letters."""
        if len(self.words) > CACHE_WORDS:
            self.reset()
        known = len(self.words)
        ids = []
        for t in texts:
            words = (t or "").split()
            ids.append(np.fromiter(map(self.words.__getitem__, words), np.int64, len(words)))
        if len(self.words) > known:
            new = [letters_of(w) for w in list(self.words)[known:]]
            self.scores = np.concatenate([self.scores, self.model.word_scores(new)])
            self.letters = np.concatenate([self.letters, np.array([len(w) for w in new], np.int64)])
        flat = np.concatenate(ids) if ids else np.empty(0, np.int64)
        lengths = np.array([len(x) for x in ids], np.int64)
        paths = best_paths(self.scores[flat], lengths)
        cuts = np.cumsum(lengths)[:-1]
        return list(zip(np.split(paths, cuts), np.split(self.letters[flat], cuts), strict=True))


def label_languages(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The language of every text, and of its spans.

    Words stand between white space. A word's scores come from its letter n-grams, among the languages written in its
    script; Viterbi with a cost for each change gives every word a language, and the text has that of most letters.

    Null, empty and letterless texts are UNKNOWN with score 0 and no spans; without any learned language all are.
    Texts are labelled whole, however long. Repeated rows are each a row. An empty table gives no rows. Extra columns
    are not read. Columns: doc_id, lang_pred, score (share of letters in that language), spans (array<struct<start,
    end, lang>> over words).
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    held: dict = {}

    def run(batch: pa.RecordBatch) -> dict:
        labeller = held.get("labeller") or held.setdefault("labeller", Labeller(shared.value))
        names = labeller.model.languages
        out: dict = {"doc_id": batch.column("doc_id"), "lang_pred": [], "score": [], "spans": []}
        for path, letters in labeller.label(batch.column("text").to_pylist()):
            total = int(letters.sum())
            if not total or not names:
                out["lang_pred"].append(UNKNOWN)
                out["score"].append(0.0)
                out["spans"].append([])
                continue
            of = np.bincount(path, letters, len(names))
            best = int(of.argmax())
            starts = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]]))
            ends = np.append(starts[1:], len(path))
            out["lang_pred"].append(names[best])
            out["score"].append(float(of[best]) / total)
            out["spans"].append([{"start": a, "end": b, "lang": names[k]} for a, b, k in zip(starts.tolist(), ends.tolist(), path[starts].tolist(), strict=True)])
        return out

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_arrow(source, run, f"doc_id {dict(source.dtypes)['doc_id']}, lang_pred string, score double, spans array<struct<start: long, end: long, lang: string>>", most=12 << 20)


def remainder(doc_id: str, divisor: int):
    """crc32 of the id as text, modulo divisor; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % divisor, F.lit(0))
