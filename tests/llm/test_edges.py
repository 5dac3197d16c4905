"""Operators on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, and whole results against brute force."""

import heapq
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dialoom.llm import chat, decontamination, embeddings, html_text, language, minhash, packing, queries, sharding, shared, substrings

from .test_llm import best_fit_by_force, docs_of, sentences

LONG = "word and more " * 60_000


def test_very_long_and_repeated_chats(spark):
    rows = [(1, i, "user", LONG if i == 3 else "x <|end|> \\<|") for i in range(30)] + [(2, 0, "user", "same")] * 3
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat.format_chats(table).collect()}
    assert [t.text for t in found[1].turns] == [r[3] for r in rows[:30]] and len(found[2].turns) == 3
    probe = chat.with_probe(table.limit(0)).collect()
    assert sorted((r.conv_id, r.turn, r.role, r.text) for r in probe) == [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def test_leaks_in_long_and_repeated_texts(spark):
    passage = sentences(1, 4, 40)[0]
    benchmark = spark.createDataFrame([(1, passage), (2, passage)], "item_id long, text string")
    table = docs_of(spark, [LONG + passage, passage, passage, LONG], [1, 2, 2, 3])
    found = Counter((r.doc_id, r.item_id) for r in decontamination.find_leaks(table, benchmark).collect())
    assert found == Counter({(1, 1): 1, (1, 2): 1, (2, 1): 2, (2, 2): 2})
    assert [r.doc_id for r in decontamination.without_leaks(table, benchmark).collect()] == [3]


def test_lots_of_a_benchmark(spark, monkeypatch):
    """A benchmark of several lots leaves the same as one of a single lot."""
    passages = sentences(9, 14, 30)
    benchmark = spark.createDataFrame(list(enumerate(passages)), "item_id long, text string")
    table = docs_of(spark, [*passages, *sentences(6, 15), None, ""])
    whole = sorted(r.doc_id for r in decontamination.without_leaks(table, benchmark).collect())
    monkeypatch.setattr(decontamination, "INDEX_CHARS", 400)
    assert sorted(r.doc_id for r in decontamination.without_leaks(table, benchmark).collect()) == whole == list(range(9, 17))
    assert {(r.doc_id, r.item_id) for r in decontamination.find_leaks(table, benchmark).collect()} == {(i, i) for i in range(9)}


def language_by_force(rows, texts):
    """n-gram log probabilities in dictionaries, and the best path word by word."""
    langs = sorted({lang for _, lang in rows})
    grams = lambda w: [g for n in language.ORDERS for s in ["\x02" + w + "\x02"] for i in range(len(s) - n + 1) if (g := s[i : i + n]).strip("\x02")]
    counts = {k: Counter(g for t, lang in rows if lang == k for w in t.split() for g in grams(language.letters_of(w))) for k in langs}
    total = {k: sum(c.values()) + 0.5 * language.BUCKETS for k, c in counts.items()}
    out = []
    for t in texts:
        words = [language.letters_of(w) for w in t.split()]
        best = {k: (0.0, []) for k in langs}
        for w in words:
            raw = {k: sum(math.log((counts[k][g] + 0.5) / total[k]) for g in grams(w)) / len(language.ORDERS) for k in langs}
            top = max(raw.values())
            new = {}
            for k in langs:
                came = max(langs, key=lambda j: best[j][0] - language.SWITCH * (j != k))
                score, path = best[came][0] - language.SWITCH * (came != k), best[came][1]
                new[k] = (score + max(raw[k] - top, language.FLOOR), [*path, k])
            best = new
        path = max(best.values(), key=lambda x: x[0])[1]
        share = Counter()
        for w, k in zip(words, path, strict=True):
            share[k] += len(w)
        out.append(share.most_common(1)[0][0])
    return out


def test_languages_against_brute_force(spark):
    draw = random.Random(2)
    make = {"aa": "abcdefg", "bb": "efghijk", "cc": "клмноп", "dd": "defghab"}
    text = lambda lang, n: " ".join("".join(draw.choice(make[lang]) for _ in range(draw.randint(2, 7))) for _ in range(n))
    rows = [(text(lang, 12), lang) for _ in range(6) for lang in make]
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string")
    model = language.fit(table, "doc_id", "text", "lang")
    texts = [text(draw.choice(list(make)), 6) + " " + text(draw.choice(list(make)), 9) for _ in range(40)]
    expected = language_by_force(rows, texts)
    found = language.label_languages(docs_of(spark, texts + texts[:2], [*range(40), 0, 1]).withColumn("score", F.lit(1)), model).collect()
    assert Counter((r.doc_id, r.lang_pred) for r in found) == Counter([(i, x) for i, x in enumerate(expected)] + [(i, expected[i]) for i in (0, 1)])


def test_equal_vectors_and_clashing_columns(spark):
    rows = [(i, [1.0, 0.0], 0, 1) for i in (5, 3, 3, 9)] + [(1, [0.0, 1.0], 0, 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, tile int").withColumns({"copies": F.lit(2), "key": F.lit("k"), "rep": F.lit(0)})
    found = Counter((r.vec_id, r.n_links, r.component_id) for r in embeddings.near_vectors(table).collect())
    assert found == Counter({(5, 2, 3): 1, (3, 2, 3): 2, (9, 2, 3): 1, (1, 0, 1): 1})


def test_whole_packing(spark, monkeypatch):
    """Every sequence is filled without a gap, as best-fit decreasing in memory fills it; repeated rows and rows without doc_id are rows."""
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    monkeypatch.setattr(packing, "PARTS", 3)
    draw = random.Random(3)
    texts = [" ".join(draw.choice(["alpha", "beta", "gamma", "don't"]) for _ in range(draw.randint(0, 900))) for _ in range(60)]
    texts = [*texts, texts[0], texts[0], None, None, "one two " * 2500]
    ids = [*range(60), 0, 0, None, None, 99]
    table = docs_of(spark, texts, ids).withColumns({"part": F.lit(1), "length": F.lit(2), "row_id": F.lit(3)})
    found = packing.pack_documents(table, path, capacity=512).collect()
    used = defaultdict(list)
    for r in found:
        used[r.sequence_id].append((r.offset, r.length))
    rooms = []
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        rooms.append(512 - at)
    assert sorted(rooms) == best_fit_by_force([r.length for r in found], 512)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    expected = Counter()
    for i, t in zip(ids, texts, strict=True):
        body = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, at in enumerate(range(0, len(body), 512)):
            expected[i, piece, at, zlib.crc32(body[at : at + 512].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.ids_crc32) for r in found) == expected


def test_tokenizers_that_see_across_words(tmp_path):
    """A tokenizer whose words depend on the space before them encodes whole texts."""
    tokenizers = pytest.importorskip("tokenizers")
    from tokenizers import models, pre_tokenizers

    t = tokenizers.Tokenizer(models.WordLevel({"▁a": 1, "▁b": 2, "[UNK]": 0}, "[UNK]"))
    t.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="first")
    file = str(tmp_path / "t.json")
    t.save(file)
    encode = packing.word_encoder(file)
    assert encode(["a b", "b  a"]) == [np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in ("a b", "b  a")]


def test_shards_by_force(spark):
    """With a unit for every group, shards are those of longest-processing-time scheduling in memory."""
    draw = random.Random(9)
    texts = [w * draw.randint(1, 60) for w in sentences(30, 3, 3)]
    rows = [(draw.choice([None, 1, 2, i]), draw.choice(texts)) for i in range(200)] + [(7, None), (8, "")]
    table = spark.createDataFrame([(i, t, 1, 1, "x", 0) for i, t in rows], "doc_id long, text string, unit int, part int, key string, row_id int")
    found = sharding.assign_shards(table, shards=5, units=10_000).collect()
    size = lambda t: len((t or "").encode()) + 16
    groups = Counter()
    for _, t in rows:
        groups[t or ""] += size(t)
    heap = [0] * 5
    for n in sorted(groups.values(), reverse=True):
        heapq.heapreplace(heap, heap[0] + n)
    loads = Counter()
    for r in found:
        loads[r.shard] += r.size
    assert sorted(loads.values()) == sorted(heap)
    for shard in loads:
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(sum(r.shard == shard for r in found)))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t in rows)
    # the few groups that a driver schedules one by one, and bundles of the rest, stay together too
    coarse = sharding.assign_shards(table, shards=5, units=2).collect()
    of = defaultdict(set)
    for r in coarse:
        of[r.text_crc32, r.size].add(r.shard)
    assert all(len(x) == 1 for x in of.values()) and len(coarse) == len(rows)
    assert sharding.assign_shards(table.limit(0)).count() == 0


def test_no_pages_and_a_long_page(spark):
    table = spark.createDataFrame([(1, "u", "<article>" + "<p>Some text, of a paragraph.</p>" * 30_000 + "</article>")], "page_id long, url string, html string")
    assert html_text.extract_main_text(table.limit(0)).count() == 0
    (r,) = html_text.extract_main_text(table.withColumns({"text": F.lit(1), "n_chars": F.lit(2)})).collect()
    assert r.n_chars == len(r.text) == 30_000 * 27 - 1


def test_stages_take_anything(spark, tmp_path):
    """Every stage of the pipeline on nulls, empty and long texts, repeated rows, clashing columns, and an empty table."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    texts = [None, "", " ", LONG, "short text", "short text", *sentences(2, 5)]
    rows = [(None if i % 3 == 0 else i % 4, t, None, "s", i, i, "h", "c") for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row long, h string, toxicity string")
    for docs in (table, table.limit(0)):
        kept = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = shared.Scratch(spark, "test").keep(stage(spark, kept, sf), name)
            assert kept.columns == docs.columns
        packed = corpus_pipeline.STAGES[-1][1](spark, kept, sf).count()
        if docs is table:
            left = [r.text for r in kept.collect()]
            assert left.count("short text") == 1 and left.count(None) + left.count("") >= 2 and LONG.strip() not in (left[0] or "") and packed >= len(left)
        else:
            assert packed == 0


def test_whole_results_on_small_tables(spark):
    """The registered queries that SQL cannot express give a row for every row, or pair, of the smallest tables."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    found = queries.op2_minhash(spark, sf).collect()
    sets = {r.doc_id: minhash.shingle_set(r.text, 2) for r in docs}
    assert {r.doc_id: r.n_shingles for r in found} == {k: len(v) for k, v in sets.items()}
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    assert {r.doc_id: r.component_id for r in found} == {k: root(k) for k in sets}
    bodies = {r.doc_id: (r.text or "").encode() for r in docs}
    seen = Counter(b[i : i + 200] for b in bodies.values() for i in range(len(b) - 199))
    removed = {}
    for k, b in bodies.items():
        mark = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                mark[i : i + 200] = b"\1" * 200
        removed[k] = sum(mark)
    assert {r.doc_id: (r.n_bytes, r.n_removed) for r in queries.op7_repeats(spark, sf).collect()} == {k: (len(b), removed[k]) for k, b in bodies.items()}
    toxic = queries.op8_toxicity(spark, sf).collect()
    assert sorted(r.doc_id for r in toxic) == ids and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in toxic)
    assert substrings.GRAM * 2 <= 200


def test_words_one_by_one_are_what_the_tokenizer_gives():
    from array import array

    from public_tokenizers import path
    from tokenizers import Tokenizer

    draw = random.Random(1)
    parts = [*"aBéÉßİΣς1٣².,;!?:|<'_-ªǅΐıſᾼ가ᄀاﷺ𝐀Åʰक漢", "x\u0301", "\u0301", "'s", "'RE", "<|", "…", " ", "  ", "\t", "\n", "\u00a0", "\u2003", "\r", "\x0b", "\x00", "word", "word,"]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        packing.word_encoder.cache_clear()
        encode, whole = packing.word_encoder(path(name)), Tokenizer.from_file(path(name))
        for _ in range(4000):
            text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 9)))
            assert encode([text])[0] == array("I", whole.encode(text, add_special_tokens=False).ids).tobytes(), repr(text)
    packing.word_encoder.cache_clear()
