"""Phrases, top-k search and filter audits against SQL or brute force, on nulls, long and empty texts, ties, repeated rows, hot groups, empty tables and clashing names."""

import math
import random
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from dialoom.llm import collocations, filter_audit, queries, topk_search

DOCS = "doc_id long, text string, lang string, source string, part string, mask int, n int, phrase string"


def docs_of(spark, rows):
    """rows: (doc_id, text, lang, source). Other columns have names that operators use inside."""
    return spark.createDataFrame([(*r, "p", 3, 4, "x") for r in rows], DOCS)


def told(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def oracle(sql, tmp_path, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
        con.execute(f"create view {name} as select * from '{tmp_path / name}/*.parquet'")
    found = con.sql(sql)
    return list(found.columns), sorted(found.fetchall(), key=repr)


# phrases


def messy_texts(n=160, seed=4):
    draw = random.Random(seed)
    words = ["New", "york", "city", "of", "the", "LOVE", "é", "x-1", "ﬀ", "İ", "漢字", " "]
    ends = [" ", "  ", "\t", ", ", ".\n", ";", ": ", "! ", "?", "\r", "\x0b", "\x0c", " . "]
    out = []
    for _ in range(n):
        text = "".join(draw.choice(words) + (" " if draw.random() < 0.8 else draw.choice(ends)) for _ in range(draw.randint(0, 60)))
        out.append(text + ("new york city of love " * draw.randint(0, 4)))
    return out


def phrase_rows():
    draw = random.Random(5)
    rows = [(i, t, draw.choice(["en", "en", "en", "fr", None, "und", ""]), "s") for i, t in enumerate(messy_texts())]
    return rows + [(900, None, "en", None), (901, "", None, "s"), (902, " \t. ,", "fr", "s"), (3, rows[3][1], "en", "s"), (3, rows[3][1], "en", "s"), (None, "of the of the of the", "en", "s")]


def phrases_by_force(rows, longest, least, factor, share, top):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for stop in ".,;:!?\n\x0b\x0c\r":
            lower = lower.replace(stop, "\n")
        for piece in lower.split("\n"):
            words = tuple(w for w in piece.replace("\t", " ").split(" ") if w)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(words[i : i + k] for i in range(len(words) - k + 1))
    out = []
    for lang, found in counts.items():
        good = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        rows_of = []
        for p, a in good.items():
            if any(len(q) > len(p) and 100 * b >= share * a and inside(p, q) for q, b in good.items()):
                continue
            cuts = [(factor * a * total[lang] // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows_of.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows_of)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out, key=repr)


PHRASE = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize("share, top", [(100, 2000), (60, 7)])
def test_phrases_against_brute_force(spark, share, top):
    rows = phrase_rows()
    found = told(collocations.find_collocations(docs_of(spark, rows), least=5, share=share, top=top), PHRASE)
    assert found == phrases_by_force(rows, 5, 5, 1000, share, top)
    assert len({r[0] for r in found}) >= 3 and max(len(r[2].split(" ")) for r in found) == 5


def test_phrases_where_the_bitmap_is_full(spark, monkeypatch):
    """Phrases that only seem frequent are counted too, and their counts decide."""
    monkeypatch.setattr(collocations, "MOST_BITS", 8)
    monkeypatch.setattr(collocations, "SLICE_BYTES", 300)
    rows = [*phrase_rows(), (999, "a long piece of love . " * 200, "en", "s")]
    assert told(collocations.find_collocations(docs_of(spark, rows), least=6), PHRASE) == phrases_by_force(rows, 5, 6, 1000, 100, 2000)


def test_phrases_of_hot_words_and_nothing(spark):
    rows = [(i, "la la la la la", "fr", "s") for i in range(300)]
    assert told(collocations.find_collocations(docs_of(spark, rows)), PHRASE) == phrases_by_force(rows, 5, 100, 1000, 100, 2000)
    assert collocations.find_collocations(docs_of(spark, [])).collect() == []
    assert collocations.find_collocations(docs_of(spark, rows[:3])).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    a, n, left, right = 9 * 10**15 + 1, 8 * 10**17 + 3, 9 * 10**15 + 7, 9 * 10**16 + 11
    row = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    wide = lambda c: f"cast({c} as decimal(19, 0))"
    found = row.select(F.expr(f"cast(1000 as decimal(38, 0)) * ({wide('a')} * {wide('n')}) div ({wide('l')} * {wide('r')})")).first()[0]
    assert found == 1000 * a * n // (left * right)


def test_phrase_query_against_its_sql(spark, tmp_path):
    rows = phrase_rows() * 12
    docs = docs_of(spark, rows)
    columns, expected = oracle(queries.OP11_SQL, tmp_path, documents=docs)
    assert columns == list(PHRASE) and told(collocations.find_collocations(docs), PHRASE) == expected and len(expected) > 20


# top-k search

VECTORS = "vec_id long, embedding array<float>, rank int, score string"


def vectors_of(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], VECTORS.replace("float", kind))


def top_by_force(rows, k, every):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % every == 0:
            long = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
            found = sorted((-long(sum(x * y for x, y in zip(a, b, strict=True))), c) for c, b in good if c != q and len(a) == len(b))
            out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(found[:k])]
    return sorted(out, key=repr)


TOP = ("query_id", "rank", "vec_id", "score")


def clustered(n, width, seed):
    """Sparse vectors around a few centres, with many equal ones."""
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, width)) * (draw.random((6, width)) < 0.3)
    out = []
    for i in range(n):
        v = centres[draw.integers(6)] + 0.05 * draw.normal(size=width) * (draw.random(width) < 0.5)
        out.append((i, [float(np.float32(x)) for x in (centres[0] if i % 3 == 0 else v)]))
    return out


@pytest.mark.parametrize("tile, group, lot_bytes", [(4096, 64, 1 << 24), (37, 3, 900)])
def test_top_k_against_brute_force(spark, monkeypatch, tile, group, lot_bytes):
    monkeypatch.setattr(topk_search, "TILE", tile)
    monkeypatch.setattr(topk_search, "GROUP", group)
    rows = clustered(600, 24, 1)
    rows += [(700, None), (750, [1.0, None]), (800, [float("nan")] * 24), (850, [float("inf")] + [0.0] * 23), (None, rows[5][1]), (900, []), (901, []), (950, [0.5, -0.25]), (1000, [0.1, 7.0]), (903, [2.0, 0.0])]
    found = told(topk_search.top_k(vectors_of(spark, rows), every=50, lot_bytes=lot_bytes), TOP)
    assert found == top_by_force(rows, 5, 50)


def test_top_k_of_repeated_rows_and_few(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [-3.0, 1.0])]
    assert told(topk_search.top_k(vectors_of(spark, rows)), TOP) == top_by_force(rows, 5, 50)
    assert topk_search.top_k(vectors_of(spark, rows[2:])).collect() == [] and topk_search.top_k(vectors_of(spark, [])).collect() == []


def test_top_k_of_any_size_of_numbers(spark):
    draw = random.Random(3)
    rows = [(i, [draw.uniform(-1, 1) * 10 ** draw.choice([0, 3, 9, 14]) for _ in range(5)]) for i in range(120)] + [(120, [1e300] * 5), (150, [1e308, 0.0, 0.0, 0.0, 0.0])]
    finite = [r for r in rows if all(math.isfinite(256 * x) for x in r[1])]
    assert told(topk_search.top_k(vectors_of(spark, rows, "double")), TOP) == top_by_force(finite, 5, 50)


def test_bounds_drop_most_of_a_shard():
    """Terms of narrow bounds are not traversed, and few vectors are probed for them."""
    width = 64
    draw = np.random.default_rng(0)
    tile = np.rint(draw.normal(size=(2000, width)) * np.where(np.arange(width) < 8, 200, 1))
    query = np.rint(np.where(np.arange(width) < 8, 100.0, 1.0))[None, :]
    best = topk_search.Best(np.array([-1]), query, 5)
    best.see(np.arange(2000), tile)
    before = best.scores.copy()
    probed = []
    original = np.einsum
    topk_search.np.einsum = lambda *a: probed.append(len(a[1])) or original(*a)
    try:
        best.see(np.arange(2000, 4000), tile)
    finally:
        topk_search.np.einsum = original
    exact = np.sort(tile @ query[0])[::-1][:5]
    assert (before[0] == exact).all() and (np.sort(np.repeat(exact, 2))[::-1][:5] == best.scores[0]).all()
    assert sum(probed) < 0.2 * 2000 * width / topk_search.PROBE


# filters


def filter_rows():
    draw = random.Random(8)
    word = lambda: draw.choice(["alpha", "beta", "Gamma", "DELTA", "ε", "Éa", "a b", "x#y", "z"])
    texts = [draw.choice([" ", "\n", "\t\x0b "]).join(word() for _ in range(draw.choice([0, 1, 30, 199, 200, 260]))) for _ in range(40)]
    texts += [" ".join(f"w{j}" for j in range(n)) for n in (199, 200, 201)] + ["A" * 2 + "b" * 98, "A" * 3 + "b" * 97, "", None, "a | b", "　" * 5]
    rows = [(i, texts[i % len(texts)], None, draw.choice(["s0", "s1", "", None])) for i in range(150)]
    # a hot text with rows of one id, without id, and a null text beside an empty one
    rows += [(500 + i // 2, "hot text", None, "s0") for i in range(200)] + [(None, "hot text", None, "s1")] * 3 + [(499, "hot text", None, "s1")] * 2 + [(None, "only here", None, None)] * 2
    draw.shuffle(rows)
    return rows


AUDIT = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit_by_force(rows, labels):
    good, toxic = ({d for d, *flags in labels if d is not None and flags[i] == 1} for i in (0, 1))
    least = {}
    for d, t, *_ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    parts = defaultdict(list)
    for d, t, _, source in rows:
        t = t or ""
        words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t).split(" ") if w]
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), "D": any(c in "#$%&*|" for c in t), "E": d is not None and least[t] < d}
        parts[source or ""].append(({x for x, bad in fails.items() if bad}, d in good, d in toxic))
    out = []
    for part, docs in parts.items():
        shapley, rows_of = Counter(), []
        for order in permutations("ABCDE"):
            left = docs
            for step, x in enumerate(order, 1):
                here = [d for d in left if x in d[0]]
                gone = len([d for d in docs if x in d[0]]) - len(here)
                left = [d for d in left if x not in d[0]]
                shapley[x] += len(here)
                rows_of.append((part, "".join(order), step, len(left), len(here), gone, len([d for d in docs if d[0] == {x}]), sum(d[1] for d in here), sum(d[2] for d in here)))
        out += [(*r, shapley[r[1][r[2] - 1]]) for r in rows_of]
    return sorted(out, key=repr)


def test_filters_against_brute_force(spark, tmp_path):
    rows = filter_rows()
    labels = [(d, d % 2, int(d % 3 == 0)) for d in range(0, 150, 2)] + [(4, 1, 1), (4, 0, 0), (6, None, None), (499, 1, 0), (None, 1, 1)]
    docs, marks = docs_of(spark, rows).repartition(5), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = told(filter_audit.audit_filters(docs, marks), AUDIT)
    assert found == audit_by_force(rows, labels) and len(found) == 600 * 3
    columns, expected = oracle(queries.OP13_SQL, tmp_path, documents=docs, labels=marks)
    assert columns == list(AUDIT) and found == expected


def test_repeated_texts_across_ranges(spark):
    """A text that fills several ranges of the sort, beside texts that begin and end in them."""
    rows = [(i, "hot", None, "s") for i in range(4000)] + [(5000 + i, f"t{i % 60}", None, "s") for i in range(240)]
    docs = docs_of(spark, rows)
    masks = filter_audit.failures(docs, filter_audit.Limits(), filter_audit.Scratch(spark, "test"), "doc_id", "text", "source")
    repeated = {r.doc_id for r in masks.where("mask >= 16").collect()}
    assert repeated == set(range(1, 4000)) | set(range(5060, 5240))


def test_filters_without_labels_or_rows(spark):
    assert filter_audit.audit_filters(docs_of(spark, [])).collect() == []
    found = filter_audit.audit_filters(docs_of(spark, [(1, None, None, None)]))
    assert {(r.part, r.removed, r.good_lost) for r in found.where("filter_order = 'ABCDE' and step = 1").collect()} == {("", 1, 0)}
