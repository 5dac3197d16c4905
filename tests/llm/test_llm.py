"""Operators against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dialoom.llm import chat, components, decontamination, embeddings, html_text, language, minhash, packing, sharding, shared, substrings, toxicity

DOCS = "doc_id long, text string, rank int, label string"
#: Names that operators use inside.
EXTRA = ("rank", "label")


def docs_of(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in zip(ids or range(len(texts)), texts, strict=True)], DOCS)


def sentences(n, seed=0, words=60):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 8))) for _ in range(400)]
    return [" ".join(draw.choice(vocabulary) for _ in range(words)) for _ in range(n)]


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def test_chats_read_back(spark):
    rows = [(1, 0, "user", "<|turn|>x\n<|end|>\n"), (1, 1, "assistant", "a\\<\\|end|> <|"), (1, 2, "sy\ns<n", None), (2, None, None, ""), (2, 0, "assistant", "ok"), (2, 0, "assistant", "ok"), (None, 0, "user", "x")]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, formatted int")
    found = {r.conv_id: r for r in chat.format_chats(table).collect()}
    assert [(t.role, t.text) for t in found[1].turns] == [(r[2], r[3] or "") for r in rows[:3]]
    assert found[1].escaped and not found[2].escaped
    assert [(t.role, t.text) for t in found[2].turns] == [("", ""), ("assistant", "ok"), ("assistant", "ok")]
    digests = {r.conv_id: r for r in chat.chat_digests(chat.format_chats(table)).collect()}
    assert digests[2].loss_sha256 == hashlib.sha256(b"okok").hexdigest() and digests[2].n_turns == 3
    assert chat.format_chats(table.limit(0)).count() == 0


def test_components(spark, tmp_path):
    draw = random.Random(3)
    links = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(150)] + [(i, i + 1) for i in range(400, 440)] + [(7, 7), (500, 501), (501, 500)]
    found = components.connected_components(spark.createDataFrame(links, "u long, v long"), shared.Scratch(spark, "test"), "cc")
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.label for r in found.collect()} == union_find(nodes, [x for x in links if x[0] != x[1]])


def near_texts():
    draw, out = random.Random(5), []
    for base in sentences(12, 1):
        words = base.split()
        out.append(base)
        for edits in (0, 1, 2, 3, 4, 5, 6, 8):
            copy = list(words)
            for _ in range(edits):
                copy[draw.randrange(len(copy))] = f"z{draw.randrange(999)}"
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("shingle", [2, 5])
def test_near_duplicates(spark, shingle):
    texts = [*near_texts(), None, "", " \t", "one", "ONE", "one two", "two one"]
    ids = list(range(100, 100 + len(texts)))
    sets = [minhash.shingle_set(t, shingle) for t in texts]
    links = [(ids[i], ids[j]) for i in range(len(texts)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    table = docs_of(spark, texts, ids).unionByName(spark.createDataFrame([(None, texts[0], 1, "x"), (100, texts[0], 1, "x")], DOCS))
    found = minhash.near_duplicates(table, shingle=shingle).collect()
    assert len(found) == len(texts) + 2
    expected = union_find(ids, links)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.kept, r.n_shingles) == (expected[r.doc_id], expected[r.doc_id] == r.doc_id, len(sets[ids.index(r.doc_id)]))
    assert minhash.near_duplicates(table.limit(0)).count() == 0


@pytest.mark.parametrize("rounds", [0, 6])
def test_near_duplicates_around_the_threshold(spark, monkeypatch, rounds):
    """A group whose members are about as far from one another as a link may be, met pivot by pivot or by differences alone; long texts, and texts of one doc_id."""
    monkeypatch.setattr(minhash, "ROUNDS", rounds)
    draw, texts = random.Random(31), []
    for words, edits, n in ((60, 3, 70), (60, 6, 90), (25, 1, 30)):
        base = sentences(1, words, words)[0].split()
        for _ in range(n):
            copy = list(base)
            for _ in range(draw.randint(0, edits)):
                copy[draw.randrange(len(copy))] = draw.choice(["x", "y", f"z{draw.randrange(99)}"])
            texts.append(" ".join(copy))
    long = sentences(1, 77, 60_000)[0]
    texts += [long, long + " end"]
    ids = [*range(300, 300 + len(texts)), 1, 1, 2, 3]
    texts += ["a b c d e f g h i j k l", "q r s t u v w x y z", "a b c d e f g h i j k l m", "q r s t u v w x y z q"]
    sets = [minhash.shingle_set(t, 2) for t in texts]
    links = [(ids[i], ids[j]) for i in range(len(texts)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    expected = union_find(set(ids), links)
    found = minhash.near_duplicates(docs_of(spark, texts, ids), shingle=2).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == sorted((i, expected[i]) for i in ids)
    assert {expected[i] for i in (1, 2, 3)} == {1} and len({expected[i] for i in ids if i >= 300}) > 5


def test_pairs_by_differences_are_whole(spark):
    """Of all pairs of members of a pivot, those that are similar are met."""
    draw, rows = random.Random(9), []
    pivot = set(range(40))
    sets = {}
    for node in range(1, 120):
        lost = set(draw.sample(sorted(pivot), draw.randint(0, 12)))
        sets[node] = (pivot - lost) | {draw.randint(100, 130) for _ in range(draw.randint(0, 8))}
        differences = sorted(sets[node] ^ pivot)
        rows.append((0, node, node, len(pivot), len(lost), len(sets[node] - pivot), differences))
    near = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    rows = [(p, n, 0 if near(sets[n], pivot) else n, *rest) for p, n, _, *rest in rows]
    label = {r[1]: r[2] for r in rows}
    wanted = {(a, b) for a in sets for b in sets if a < b and label[a] != label[b] and near(sets[a], sets[b])}
    table = spark.createDataFrame(rows, "pivot long, node long, label long, size long, lost long, added long, differences array<long>")
    found = {tuple(sorted(x)) for x in minhash.linkable(table, 80).collect()}
    assert wanted and wanted <= found and len(found) < len(sets) ** 2 / 8


def test_shared_counts():
    draw = random.Random(3)
    for n, m, often in ((1, 1, 1), (40, 30, 8), (200, 150, 3)):
        sets = [[{draw.randrange(20) for _ in range(draw.randrange(often + 4))} | {draw.randrange(10**6) % 900 + 50 for _ in range(12)} for _ in range(x)] for x in (n, m)]
        sides = [(np.array([v for s in side for v in s], np.int64), np.array([i for i, s in enumerate(side) for _ in s], np.int64), len(side)) for side in sets]
        assert minhash.shared_counts(*sides).tolist() == [[len(a & b) for b in sets[1]] for a in sets[0]]
    empty = (np.empty(0, np.int64), np.empty(0, np.int64), 3)
    assert minhash.shared_counts(empty, sides[1]).shape == (3, 150)


@pytest.mark.parametrize("tile", [7, 4096])
def test_tiles_join_what_pairs_join(spark, monkeypatch, tile):
    """Links of tiles join the labels that all similar pairs of a pivot's members join, each of them similar."""
    draw, rows, sets = random.Random(5), [], {}
    for pivot, members in ((0, 90), (1000, 25), (2000, 1)):
        whole, kinds = set(range(60)), [set(draw.sample(range(60), 15)) for _ in range(12)]
        for node in range(pivot + 1, pivot + 1 + members):
            lost = (draw.choice(kinds) | set(draw.sample(range(60), 4))) if draw.random() < 0.7 else set(draw.sample(range(60), draw.randint(0, 9)))
            sets[node] = (whole - lost) | {draw.randint(100, 104) for _ in range(3)}
            near_pivot = 100 * len(sets[node] & whole) >= 80 * len(sets[node] | whole)
            rows.append((pivot, node, pivot if near_pivot else node, 60, len(lost), len(sets[node] - whole), sorted(sets[node] ^ whole)))
    near = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    label = {r[1]: r[2] for r in rows}
    group = {r[1]: r[0] for r in rows}
    wanted = [(a, b) for a in sets for b in sets if a < b and group[a] == group[b] and near(a, b)]
    monkeypatch.setattr(minhash, "CROWD", 0)
    monkeypatch.setattr(minhash, "TILE", tile)
    table = spark.createDataFrame(rows, "pivot long, node long, label long, size long, lost long, added long, differences array<long>")
    found = [tuple(x) for x in minhash.linkable(table, 80, shared.Scratch(spark, "test")).collect()]
    assert all(a < b and near(a, b) and label[a] != label[b] for a, b in found)
    by_label = lambda links: union_find(set(label.values()), [(label[a], label[b]) for a, b in links])
    assert by_label(found) == by_label(wanted) != by_label([])
    assert tile == 7 or len(found) < len(sets)


def test_mixtures_of_the_same_parts(spark, monkeypatch):
    """Documents that share half of their optional clauses make no rows of pairs, and those that share more are linked."""
    draw = random.Random(11)
    clause = lambda i: " ".join(f"w{i}x{j}" for j in range(10))
    texts = [" ".join(clause(i) for i in [*range(37), *sorted(draw.sample(range(40, 80), 20))]) for _ in range(200)]
    for text in texts[:20]:
        texts.append(text.replace(clause(36), clause(99)))
    sets = [minhash.shingle_set(t, 5) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    keep, rows = shared.Scratch.keep, {}

    def counted(self, df, name, by=None):
        out = keep(self, df, name, by)
        if name.startswith("linkable"):
            rows[name] = out.count()
        return out

    monkeypatch.setattr(shared.Scratch, "keep", counted)
    found = minhash.near_duplicates(docs_of(spark, texts)).collect()
    assert {r.doc_id: r.component_id for r in found} == union_find(range(len(texts)), links)
    assert rows and max(rows.values()) < 2 * len(texts)


def removed_by_force(bodies, width):
    seen = Counter(b[i : i + width] for b in bodies for i in range(len(b) - width + 1))
    out = []
    for b in bodies:
        mark = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i : i + width]] > 1:
                mark[i : i + width] = b"\1" * width
        out.append(mark)
    return out


@pytest.mark.parametrize("sorted_at_once", [1, 3, 1000])
def test_repeats(spark, monkeypatch, sorted_at_once):
    monkeypatch.setattr(substrings, "AT_ONCE", sorted_at_once)
    monkeypatch.setattr(substrings, "SEGMENT", 700)
    base = sentences(14, 2)
    shared_part = base[0][:150]
    texts = [*base[:4], *(b[:90] + shared_part + b[200:] for b in base[4:12]), base[0], "é" * 300, "ab" * 200, base[3] * 3, None, "", "short"]
    # one passage in other surroundings, wholly and in parts
    texts += [f"{i}{base[12][:40]}|" + base[13][5 * i : 260 - 3 * i] + f"|{base[12][i:90]}{i}" for i in range(14)]
    table = docs_of(spark, texts, [i % 19 for i in range(len(texts))])
    found = substrings.remove_repeats(table, width=100)
    assert found.columns == ["doc_id", "text", "n_bytes", "n_removed", "spans", "kept_sha256", "rest"]
    bodies = [(t or "").encode() for t in texts]
    expected = Counter()
    for (i, b), mark in zip(enumerate(bodies), removed_by_force(bodies, 100), strict=True):
        kept = bytes(x for x, m in zip(b, mark, strict=True) if not m)
        spans = tuple((s, s + len(part)) for s, part in runs_of(mark))
        expected[i % 19, len(b), sum(mark), spans, hashlib.sha256(kept).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, tuple((s.start, s.end) for s in r.spans), r.kept_sha256) for r in found.collect()) == expected
    assert substrings.remove_repeats(table.limit(0)).count() == 0
    assert not [t.name for t in spark.catalog.listTables() if "substrings" in t.name]


def test_rounds_of_a_large_bucket(spark, monkeypatch):
    """A bucket that stays large at every distance but one comes down to it in three rounds."""
    monkeypatch.setattr(substrings, "AT_ONCE", 1)
    draw, core = random.Random(5), sentences(1, 6)[0]
    some = lambda n: "".join(draw.choice("abc ") for _ in range(n))
    texts = [some(150) + core[100 - k : 300 + k] + some(150) for k in range(0, 90, 6)]
    rounds, keep = [], shared.Scratch.keep

    def counted(self, df, name, by=None):
        rounds.append(name)
        return keep(self, df, name, by)

    monkeypatch.setattr(shared.Scratch, "keep", counted)
    found = {r.doc_id: r.n_removed for r in substrings.remove_repeats(docs_of(spark, texts)).collect()}
    assert found == {i: sum(m) for i, m in enumerate(removed_by_force([t.encode() for t in texts], 200))}
    assert 1 <= sum(name.startswith("parts-") for name in rounds) <= 3


def runs_of(mark):
    start = None
    for i, m in enumerate([*mark, 0]):
        if m and start is None:
            start = i
        elif not m and start is not None:
            yield start, mark[start:i]
            start = None


def test_buckets_agree():
    draw = random.Random(8)
    gram = bytes(draw.choice(b"xyz") for _ in range(32))
    members = []
    for k in range(14):
        left, right = (bytes(draw.choice(b"ab") for _ in range(40)) for _ in range(2))
        left, right = (b"c" * 36 + left[:4], right[:3] + b"d" * 37)
        n = draw.randint(1, 20)
        anchor = draw.randint(n - 1, 40)
        members.append((n, anchor, 0, (left + gram + right + b"e" * 60)[40 - anchor : 40 - anchor + n - 1 + 64]))
    few = substrings.FEW
    try:
        found = []
        for substrings.FEW in (0, 99):
            found.append([{s for lo, hi in x for s in range(lo, hi + 1)} for x in substrings.repeated_in_bucket(members, 64)])
    finally:
        substrings.FEW = few
    assert found[0] == found[1]


def test_leaks(spark):
    passages = sentences(6, 4, 40)
    clean = sentences(5, 9, 80)
    edited = passages[2][:60] + "q" + passages[2][60:150] + passages[2][152:]
    texts = [clean[0] + " " + passages[0].upper().replace(" ", " \n ") + " " + clean[1], clean[2], clean[3] + edited, passages[4][20:180], None, "", passages[5][:30]]
    benchmark = spark.createDataFrame([*((i, p, 1) for i, p in enumerate(passages)), (None, passages[0], 1), (90, None, 1), (91, "tiny", 1)], "item_id long, text string, rank int")
    table = docs_of(spark, texts)
    assert sorted({(r.doc_id, r.item_id) for r in decontamination.find_leaks(table, benchmark).collect()}) == [(0, 0), (2, 2), (3, 4)]
    kept = decontamination.without_leaks(table, benchmark)
    assert kept.columns == table.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6]
    assert decontamination.find_leaks(table, benchmark.limit(0)).count() == 0 and decontamination.without_leaks(table, benchmark.limit(0)).count() == len(texts)
    assert decontamination.find_leaks(table.limit(0), benchmark).count() == 0


def test_alignment_is_edit_distance():
    def best(probe, text):
        row = [0] * (len(text) + 1)
        for i, p in enumerate(probe):
            new = [i + 1]
            for j, t in enumerate(text):
                new.append(min(row[j] + (p != t), row[j + 1] + 1, new[j] + 1))
            row = new
        return min(row)

    draw = random.Random(1)
    for _ in range(60):
        probe = "".join(draw.choice("ab") for _ in range(24))
        text = list(probe)
        for _ in range(draw.randint(0, 4)):
            at = draw.randrange(len(text))
            text[at : at + 1] = draw.choice([[], ["c"], ["c", text[at]]])
        text = "xx" + "".join(text) + "yyyy"
        found = decontamination.aligned(probe, text + "z" * 6, 4)
        assert (found[1] if found else 9) >= best(probe, text + "z" * 6)
        if best(probe, text) <= 2:
            assert found is not None


def test_leaks_with_deletions_at_both_ends_of_a_text():
    assert decontamination.aligned("abcdef", "abdef", 1) == (5, 1)
    passages = [(i, decontamination.normal(t[:100])) for i, t in enumerate(sentences(20, 33, 40))]
    found_by = decontamination.indexes(passages)
    [index] = found_by
    filler, draw = sentences(1, 34)[0], random.Random(3)
    for item, text in passages:
        for k in range(1, index.probes[item].edits):  # a cut at a space can cost one more
            at = sorted(draw.sample(range(30, 95), k))
            cut = "".join(c for i, c in enumerate(text) if i not in at)
            for leak in (cut, text[k:], text[: len(text) - k]):
                for body in (leak, filler + " " + leak, leak + " " + filler):
                    start, end, _, edits = decontamination.leaks_in(body, found_by)[item]
                    assert edits <= index.probes[item].edits and 0 <= start < end <= len(decontamination.normal(body))


def distance_in(probe, body):
    """Edits between a probe and the best place of it in a text."""
    row = np.zeros(len(body) + 1, np.int64)
    chars = np.array(list(body))
    steps = np.arange(len(body) + 1)
    for i, c in enumerate(probe):
        best = np.concatenate([[i + 1], np.minimum(row[:-1] + (chars != c), row[1:] + 1)])
        row = np.minimum.accumulate(best - steps) + steps
    return int(row.min())


def test_leaks_are_all_within_the_budget():
    """Every probe against full edit distance, up to the whole budget, wherever the copy is."""
    draw = random.Random(17)
    items = [(i, decontamination.normal(t[:n])) for i, (t, n) in enumerate(zip(sentences(24, 51, 60), [*range(40, 100, 5), *[180] * 12], strict=True))]
    found_by = decontamination.indexes(items)
    [index] = found_by
    fillers, checked = sentences(3, 52, 20), 0
    for item, text in items:
        for _ in range(6):
            copy = list(text)
            for _ in range(draw.randint(0, 2 * int(min(len(text), 100) * decontamination.EDITS))):
                at = draw.randrange(len(copy))
                copy[at : at + 1] = draw.choice([[], ["~"], ["~", copy[at]]])
            leak = "".join(copy)
            for body in (leak, leak + " " + fillers[0], fillers[1] + " " + leak, fillers[1] + " " + leak + " " + fillers[2]):
                body = decontamination.normal(body)
                wanted = {p.item for p in index.probes if distance_in(p.text, body) <= p.edits}
                assert wanted == set(decontamination.leaks_in(body, found_by))
                checked += bool(wanted)
    assert checked > 200


def test_short_passages_and_all_places():
    items = [(1, "paris"), (2, "ab"), (3, "what is the capital of france?"), (4, decontamination.normal(sentences(1, 3, 30)[0][:90]))]
    found_by = decontamination.indexes([*items, (5, "")])
    of = lambda body: {k: v[:3] for k, v in decontamination.leaks_in(body, found_by).items()}
    assert of("x ab y Paris z paris") == {2: (2, 4, 1), 1: (7, 20, 2)}
    assert of("comparison, drab abc") == {} and of("") == {} and of(None) == {}
    assert of("so what is the capitol of France? yes") == {3: (3, 33, 1)}
    long = items[3][1]
    assert of(f"{long} and {long}") == {4: (0, 2 * len(long) + 5, 2)}
    assert decontamination.leaks_in(" ".join(["filler"] * 100_000 + ["paris"]), found_by).keys() == {1}


def test_languages(spark):
    draw = random.Random(2)
    make = {"aa": "abcde", "bb": "vwxyz", "cc": "клмно"}
    text = lambda lang, n=30: " ".join("".join(draw.choice(make[lang]) for _ in range(5)) for _ in range(n))
    rows = [(i, text(lang), lang) for i in range(20) for lang in make]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "text", "lang")
    mixed = text("aa", 20) + " " + text("cc", 40)
    texts = [text("aa"), text("bb"), text("cc"), mixed, None, "", "12 34!", text("bb", 3000)]
    found = {r.doc_id: r for r in language.label_languages(docs_of(spark, texts), model).collect()}
    assert [found[i].lang_pred for i in range(8)] == ["aa", "bb", "cc", "cc", "und", "und", "und", "bb"]
    assert [(s.lang, s.start, s.end) for s in found[3].spans] == [("aa", 0, 20), ("cc", 20, 60)]
    assert all(0 <= r.score <= 1 for r in found.values())
    assert language.label_languages(docs_of(spark, texts).limit(0), model).count() == 0
    nothing = language.fit(spark.createDataFrame([], "doc_id long, text string, lang string"), "doc_id", "text", "lang")
    assert {r.lang_pred for r in language.label_languages(docs_of(spark, texts), nothing).collect()} == {"und"}


def test_viterbi_is_best_path():
    draw = np.random.default_rng(3)
    lengths = np.array([4, 0, 6, 1])
    scores = draw.normal(size=(11, 3)) * 3
    found, at = language.best_paths(scores, lengths, 2.0), 0
    for n in lengths:
        part = scores[at : at + n]

        def value(path, part=part):
            return sum(part[i][s] for i, s in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:], strict=False))

        paths = [[]]
        for _ in range(n):
            paths = [[*p, s] for p in paths for s in range(3)]
        assert value(found[at : at + n].tolist()) == pytest.approx(max(map(value, paths)))
        at += n


def test_many_languages():
    draw = np.random.default_rng(5)
    for n in (200, 300):
        scores = draw.normal(size=(40, n)) * 0.1
        scores[:, n - 5] += 3
        assert (language.best_paths(scores, np.array([40])) == n - 5).all()


def test_vectors_of_any_size(spark):
    """Labels and numbers that look alike when joined, numbers whose squares are out of range, and tiles of several products."""
    rows = [(1, [2.0], "a,1.0"), (2, [1.0, 2.0], "a"), (3, [1e200, 0.0], "b"), (4, [1e200, 1.0], "b"), (5, [1e-200, 0.0], "b"), (6, [0.0, 1e-320], "b"), (7, [5e-324, 0.0], "b")]
    found = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()}
    assert found == {1: (0, 1), 2: (0, 2), 3: (3, 3), 4: (3, 3), 5: (3, 3), 6: (0, 6), 7: (3, 3)}
    draw = np.random.default_rng(7)
    left, right = embeddings.unit(draw.normal(size=(70, 3))), embeddings.unit(draw.normal(size=(50, 3)))
    whole = set(zip(*(x.tolist() for x in embeddings.close_pairs(left, right, 0.9)), strict=True))
    product, embeddings.PRODUCT = embeddings.PRODUCT, 16
    try:
        assert set(zip(*(x.tolist() for x in embeddings.close_pairs(left, right, 0.9)), strict=True)) == whole
    finally:
        embeddings.PRODUCT = product


def test_vectors(spark):
    draw = np.random.default_rng(4)
    rows, centre = [], draw.normal(size=(12, 16))
    for i in range(160):
        v = centre[i % 12] + draw.normal(size=16) * draw.choice([0.0, 0.1, 0.25, 0.4])
        rows.append((i, [float(np.float32(x)) for x in v], i % 2))
    rows += [(200, None, 0), (201, [], 0), (202, [0.0] * 16, 0), (203, [float("nan")] * 16, 0), (204, rows[0][1], None), (205, [1.0, None], 0), (206, rows[0][1], 0), (207, rows[0][1], 1), (208, [1.0, 0.0], 0), (209, [2.0, 0.0], 0), (None, rows[0][1], 0)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, tile int")
    good = {i: (np.array(v, float) / np.linalg.norm(v), lab) for i, v, lab in rows if i is not None and lab is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    links = [(a, b) for a in good for b in good if a > b and good[a][1] == good[b][1] and len(good[a][0]) == len(good[b][0]) and float(good[a][0] @ good[b][0]) >= 0.93]
    expected, degree = union_find([r[0] for r in rows if r[0] is not None], links), Counter(x for link in links for x in link)
    for tile in (13, 2048):
        found = embeddings.near_vectors(table, tile=tile).collect()
        assert len(found) == len(rows)
        for r in found:
            assert (r.n_links, r.component_id) == (degree[r.vec_id], expected.get(r.vec_id))
    assert embeddings.near_vectors(table.limit(0)).count() == 0


def test_quantisation_bound():
    draw = np.random.default_rng(6)
    units = embeddings.unit(draw.normal(size=(300, 24)))
    levels, scale, error = embeddings.quantised(units)
    gap = np.abs(units @ units.T - (levels.astype(float) @ levels.T.astype(float)) * scale[:, None] * scale[None, :])
    assert (gap <= error[:, None] + error[None, :] + error[:, None] * error[None, :]).all()


def best_fit_by_force(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - n)
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


def test_best_fit_plan():
    draw = random.Random(7)
    for _ in range(80):
        capacity = draw.choice([10, 33, 64])
        lengths = [draw.randint(1, capacity) for _ in range(draw.randint(1, 120))]
        plan, bins = packing.plan_best_fit(Counter(lengths), capacity)
        used, ranks = defaultdict(list), Counter()
        for length, rank, start, n, offset in plan:
            assert rank == ranks[length]
            ranks[length] += n
            for b in range(start, start + n):
                used[b].append((offset, length))
        assert ranks == Counter(lengths) and len(used) == bins
        for pieces in used.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= capacity
        assert sorted(capacity - sum(n for _, n in p) for p in used.values()) == best_fit_by_force(lengths, capacity)


def test_packing(spark):
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    texts = [*sentences(30, 6), None, "", "A B\tc\n d  é <|endoftext|> x", "İstanbul ΑΣ ｆｕｌｌ it's don't 3.14 …!!", "long word " * 3000]
    tokenizer = Tokenizer.from_file(path)
    found = packing.pack_documents(docs_of(spark, texts), path).collect()
    pieces = defaultdict(dict)
    for r in found:
        pieces[r.doc_id][r.piece] = (r.start, r.length, r.ids_crc32)
    for i, t in enumerate(texts):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        expected = {p: (p * 2048, len(ids[p * 2048 : p * 2048 + 2048]), zlib.crc32(ids[p * 2048 : p * 2048 + 2048].tobytes())) for p in range(-(-len(ids) // 2048))}
        assert pieces[i] == expected
    assert packing.pack_documents(docs_of(spark, texts).limit(0), path).count() == 0


def test_toxicity(spark):
    draw = random.Random(11)
    clean = sentences(300, 21, 30)
    rows = [(i, t if i % 5 else t + " " + draw.choice(["zorgblat", "kwumpish", "zorgblatti"]), int(i % 5 == 0)) for i, t in enumerate(clean)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(table, table)
    texts = [clean[1], clean[2] + " Zorgblat!", clean[3] + " z o r g b l a t", clean[4] + " zorgxblat", None, "", "1 2"]
    found = {r.doc_id: r.score for r in toxicity.score_texts(docs_of(spark, texts).withColumn("score", F.lit(9)), model).collect()}
    assert [found[i] >= 0.5 for i in range(7)] == [False, True, True, True, False, False, False]
    # inserted characters, words cut by a mark, in the middle of a long text; repeated rows
    forms = ["kwum-pish", "zo rgblat", "k.w.u.m.p.i.s.h", "zorg*blat", "kwumpiish", " ".join(clean[100:160]) + " kwumpish " + " ".join(clean[160:220]), "x" * 200_000, "zorgblat", "zorgblat"]
    scores = [r.score for r in toxicity.score_texts(docs_of(spark, [f if " " in f[3:] else clean[9] + " " + f for f in forms]), model).orderBy("doc_id").collect()]
    assert [x >= 0.5 for x in scores] == [True, True, True, True, True, True, False, True, True]
    assert toxicity.score_texts(docs_of(spark, texts).limit(0), model).count() == 0
    unlabelled = toxicity.fit(table, table.where("toxic = 0"))
    assert all(r.score < 0.5 for r in toxicity.score_texts(docs_of(spark, texts), unlabelled).collect())
    assert all(r.score < 0.5 for r in toxicity.score_texts(docs_of(spark, texts), toxicity.fit(table.limit(0), table)).collect())


def test_toxicity_of_several_words(spark):
    """Words that are harmless by themselves, toxic one after the other."""
    draw = random.Random(5)
    words = ["grem", "polk", *("".join(draw.choice("abcdefghij") for _ in range(5)) for _ in range(200))]
    rows = []
    for i in range(400):
        text = [draw.choice(words) for _ in range(30)]
        text = [w for w, before in zip(text, [None, *text], strict=False) if (before, w) != ("grem", "polk")]
        if i % 4 == 0:
            text[7:7] = ["grem", "polk"]
        rows.append((i, " ".join(text), int(i % 4 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(table.where("doc_id < 300"), table)
    found = {r.doc_id: (r.score >= 0.5, r.toxic) for r in toxicity.score_texts(table.where("doc_id >= 300"), model).collect()}
    assert sum(a != bool(b) for a, b in found.values()) <= 2


def subsequences_by_force(string):
    """Every pattern's subsequences that begin in the first WIDTH letters, and their weights."""
    out = defaultdict(float)
    for start in range(min(len(string), toxicity.WIDTH)):
        for offsets in toxicity.PATTERNS:
            if start + offsets[-1] < len(string):
                out["".join(string[start + o] for o in offsets)] += toxicity.DECAY ** (offsets[-1] + 1) / toxicity.LENGTH
    return out


def test_toxicity_scores_are_a_kernel_machine():
    """Margins of whole texts against the machine computed string by string with the kernel by brute force."""
    draw = random.Random(12)
    word = lambda: "".join(draw.choice("abcdef") for _ in range(draw.randint(1, 7)))
    strings = ["_" + "_".join(word() for _ in range(6))[:20] for _ in range(30)]
    kernel = lambda a, b: sum(v * subsequences_by_force(b).get(k, 0) for k, v in subsequences_by_force(a).items())
    assert np.allclose(toxicity.kernel_with(strings, strings[:7]), [[kernel(a, b) for b in strings[:7]] for a in strings], atol=1e-5)
    # all strings as landmarks: the machine is the kernel's own
    model = toxicity.fit_strings(strings[:10], strings[10:])
    gram = np.array([[kernel(a, b) for b in strings] for a in strings])
    values, vectors = np.linalg.eigh(gram)
    root = vectors * np.sqrt(np.maximum(values, 0))
    y = np.array([1.0] * 10 + [-1.0] * 20)
    exact = toxicity.support_vectors(root, y, np.where(y > 0, 2**0.5, 1.0))
    alpha = vectors @ (exact[:-1] / np.sqrt(np.maximum(values, 1e-9)))
    sentences_of = [[word() for _ in range(draw.randint(1, 9))] for _ in range(12)]
    for sentence in sentences_of:
        line = "_" + "_".join(sentence) + "_"
        cuts = [line[i : i + toxicity.WIDTH + toxicity.REACH] for i in range(len(line)) if i == 0 or i + toxicity.WIDTH <= len(line) - 1]
        if any(len(w) == 1 for w in sentence):
            continue
        by_force = max(exact[-1] + sum(a * kernel(cut, b) for a, b in zip(alpha, strings, strict=True)) for cut in cuts)
        assert model.best([" ".join(sentence)])[0][0] == pytest.approx(max(by_force, exact[-1]), abs=0.02)


def test_letters_of_texts():
    shown = lambda texts: "".join(map(chr, toxicity.Letters.of(texts).codes.tolist()))
    assert shown(["Hello YOU. I d i o t!! A b", "", None, "x,y 12z"]) == "_hello_you_idiot_a_b_xyz_"
    assert shown(["i.d.i.o.t a b"]) == "_idiotab_" and shown([]) == "_" and shown([None]) == "_"
    letters = toxicity.Letters.of(["a. bc", "d"])
    assert letters.end.tolist() == [True, False, True, False, False, True, False, True] and letters.text.tolist()[:7] == [0, 0, 0, 0, 0, 1, 1]


def test_kernel_is_a_gram_matrix():
    words = ["idiot", "idxiot", "window", "idiotic", "ab", ""]
    of, at, weight = toxicity.features(words)
    dense = np.zeros((len(words), toxicity.BUCKETS))
    np.add.at(dense, (of, at), weight)
    assert np.allclose(toxicity.kernel_with(words, words), dense @ dense.T)


def test_shards(spark):
    texts = [*sentences(200, 12, 20), *["same text"] * 90, None, None, "", *sentences(1, 12, 900)]
    table = docs_of(spark, texts).unionByName(docs_of(spark, texts[:1]))
    for units in (1, 4, 256):
        found = sharding.assign_shards(table, shards=5, units=units).collect()
        assert len(found) == len(texts) + 1
        at = defaultdict(set)
        for r in found:
            body = (texts[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(body) + 16, zlib.crc32(body))
            at[body].add(r.shard)
        assert all(len(s) == 1 for s in at.values())
        slots = defaultdict(list)
        for r in found:
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    loads = Counter()
    for r in found:
        loads[r.shard] += r.size
    assert max(loads.values()) <= 1.2 * sum(loads.values()) / 5 + 5400
    assert sharding.assign_shards(table.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies, really.</div>
<div id="content"><h1>Big  &amp; small</h1><p>First <b>paragraph</b>, with some\n text in it, long enough.<br>Next line.<p>Second one has, also, punctuation; it is long.
<blockquote>Quoted words, here.</blockquote><form><input><p>Name</p></form><div class="comments"><p>Great article, thanks, everyone!</p></div></div>
<aside><p>Related, things, to read.</p></aside><footer>&copy; site</footer><!-- end --></body></html>"""


def test_pages(spark):
    expected = "Big & small\nFirst paragraph, with some text in it, long enough. Next line.\nSecond one has, also, punctuation; it is long.\nQuoted words, here."
    pages = [(1, "u", PAGE, 1), (2, None, None, 1), (3, "u", "", 1), (4, "u", "<p>only &lt;this&gt;", 1), (5, "u", "<!-- open <p>x</p>", 1), (5, "u", "plain", 1)]
    found = html_text.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string, text int")).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in found) == sorted([(1, expected, len(expected)), (2, "", 0), (3, "", 0), (4, "only <this>", 11), (5, "", 0), (5, "plain", 5)])


def test_pages_keep_all_sections():
    line = lambda c, n: " ".join([c * 5] * n) + "."
    p = lambda *texts: "".join(f"<p>{t}</p>" for t in texts)
    body, lead, rest = [line("b", 60), line("c", 70)], line("l", 8), [line("d", 20), line("e", 14)]
    page = f"<body><nav>Home</nav><article><h1>Title</h1><p>{lead}</p><div class=body>{p(*body)}</div></article><footer>x</footer></body>"
    assert html_text.main_text(page) == "\n".join(["Title", lead, *body])
    for tag in ("section", "div"):
        for outer in ("article", "main", "div"):
            page = f"<body><nav>Home</nav><{outer}><{tag}>{p(*body)}</{tag}><{tag}>{p(*rest)}</{tag}></{outer}></body>"
            assert html_text.main_text(page) == "\n".join(body + rest)


def unmarked_page(draw):
    """A page without a telling tag or class, and its text."""
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 9)))
    sentence = lambda n: " ".join(word() for _ in range(n)) + ", " + word() + "."
    links = lambda n: "<ul>" + "".join(f'<li><a href="/x">{word()}</a></li>' for _ in range(n)) + "</ul>"
    text = [" ".join(sentence(draw.randint(8, 16)) for _ in range(draw.randint(2, 6))) for _ in range(draw.randint(4, 9))] + [word()]
    title = word() + " " + word()
    body = f"<h1>{title}</h1>" + "".join(f"<p>{x}</p>" for x in text)
    page = f"<html><head><title>{title}</title></head><body><div>{links(8)}</div><div><div class='{draw.choice(['has-sidebar', 'no-sidebar', 'with-nav', 'c7'])}'>{body}</div></div><div><div><span>{word()}</span></div>{links(6)}</div></body></html>"
    return page, "\n".join([title, *text])


def test_ratios_choose_the_text(monkeypatch):
    draw = random.Random(41)
    pages = [unmarked_page(draw) for _ in range(60)]
    assert [html_text.main_text(page) for page, _ in pages] == [text for _, text in pages]
    monkeypatch.setattr(html_text, "content_scores", lambda blocks, texts: [1.0] * len(blocks))
    assert sum(html_text.main_text(page) == text for page, text in pages) < 5


def test_marks_beside_the_article():
    p = "<p>A long paragraph, with commas, and more than one sentence. It goes on, and on.</p>"
    said = p[3:-4]
    wrapped = lambda c: f'<body><div class="{c}"><article>{p * 3}</article></div><div class="sidebar"><p>Related, news, here.</p></div></body>'
    for c in ("has-sidebar", "no-sidebar", "with-nav", "side-by-side", "sidebar"):
        assert html_text.main_text(wrapped(c)) == "\n".join([said] * 3)
    page = f"<article><h1>T</h1>{p}<p class=notice-period>The notice period, is three months.</p><p class=ad-free-summary>Short one.</p>{p}<div class=comments><p>nice, read. Good</p></div></article>"
    assert html_text.main_text(page) == "\n".join(["T", said, "The notice period, is three months.", "Short one.", said])
    # quotes that are not closed, or not in this tag; quoted marks that are
    assert html_text.main_text(f'<p>a<a href="x>link</a> text</p>{p}') == f"alink text\n{said}"
    assert html_text.main_text(f'<p>a<a href="x>link</a> <b class="y">text</b></p>{p}') == f"alink text\n{said}"
    assert html_text.main_text(f'<p title="a > b">text</p>{p}') == f"text\n{said}"


def test_articles_that_are_not_the_page_s():
    p = "<p>A long paragraph, with commas, and more than one sentence. It goes on, and on.</p>"
    said, other = p[3:-4], "<p>What a reader wrote, at some length, with commas, and in several sentences. Really, it is long.</p>"
    main = f"<main><h1>T</h1>{p * 3}</main>"
    for beside in (
        f'<section class="comments"><article class="comment-body">{other * 3}</article></section>', f'<aside><article class="teaser">{other}</article></aside>', f'<div id="disqus_thread"><article>{other * 3}</article></div>',
        f'<article class="comment">{other * 4}</article>', f'<div class="related-posts"><article><h3>More</h3>{other}</article></div>', f'<footer><main>{other}</main></footer>',
    ):
        assert html_text.main_text(f"<body>{main}{beside}</body>") == "\n".join(["T", said, said, said])
        assert html_text.main_text(f"<body>{beside}<article><h1>T</h1>{p * 3}</article></body>") == "\n".join(["T", said, said, said])
    # what says that there are comments, or none, bars nothing
    for c in ("comments-open", "has-comments", "post comments-closed", "main-content"):
        assert html_text.main_text(f'<body><div class="{c}"><article class="post comments-open">{p * 3}</article></div></body>') == "\n".join([said] * 3)
    assert html_text.main_text(f'<form><article>{p * 2}</article></form>') == f"{said}\n{said}"


def test_marks_are_of_class_id_and_role():
    p = "<p>A long paragraph, with commas, and more than one sentence. It goes on, and on.</p>"
    said = p[3:-4]
    for tag in ('div data-id="comments-12"', 'div data-class="ad"', 'div title="id=comments"', 'section id="legal"', 'section id="search"', 'section id=share', "div aria-id='nav'", 'div xid="ads"'):
        name = tag.split(" ")[0]
        assert html_text.main_text(f"<article>{p}<{tag}><p>Inside, short.</p></{name}>{p}</article>") == f"{said}\nInside, short.\n{said}"
    for tag in ('div id="comments"', "div class=ad", 'section ID="related"', "div CLASS = 'comments'"):
        name = tag.split(" ")[0]
        assert html_text.main_text(f"<article>{p}<{tag}><p>Inside, short.</p></{name}>{p}</article>") == f"{said}\n{said}"


def test_inline_and_unknown_elements_split_nothing():
    page = "<article><p>We know that <math><mi>a</mi><mo>=</mo><mn>1</mn></math> holds, <my-tip>for all</my-tip> <ruby>x<rt>y</rt></ruby> and<script>s()</script> more<svg><text>no</text></svg>.</p><p>Next<hr>line</p></article>"
    assert html_text.main_text(page) == "We know that a=1 holds, for all xy and more.\nNext\nline"


def test_pages_without_an_article():
    p = "<p>A long paragraph, with commas, and more than one sentence. It goes on, and on.</p>"
    said = p[3:-4]
    page = f'<body><ul><li><a href="/">Home</a></li><li><a href="/n">News</a> </li></ul><h1>T</h1>{p}<p>See <a>this</a>.</p>{p}<h2>3 Comments</h2><div>{p}</div><p>nice</p></body>'
    assert html_text.main_text(page) == f"T\n{said}\nSee this.\n{said}"
    assert html_text.main_text(f"<div><div><h2>Comments</h2><p>nice, good. Yes, and more, and more.</p></div><div><h1>T</h1>{p * 3}</div></div>") == "\n".join(["T", said, said, said])


@pytest.mark.parametrize("part", ['<a "', "<div>", "<div>x", "<p><h1>", "<b>", "<!--", "<script>", "<title></titl>", "<a x=\"<b>", "<", "</x ", "<dt><div>"])
def test_broken_pages_take_linear_time(part):
    import time

    def seconds(n):
        began = time.process_time()
        html_text.main_text(part * (n // len(part)))
        return time.process_time() - began

    small, large = seconds(100_000), seconds(800_000)
    assert large < 1 + 24 * small


def test_pipeline_keeps_one_of_repeated_rows(spark):
    import corpus_pipeline

    once, near, bare, short = sentences(3, 21) + ["a b"]
    rows = [(7, once), (7, once), (3, near + " zz"), (None, near), (None, bare), (None, bare), (9, None), (9, None), (None, short), (None, short), (4, short)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    expected = Counter([(7, once), (3, near + " zz"), (None, bare), (9, None), (9, None), (4, short)])
    assert Counter(tuple(r) for r in kept.collect()) == expected
    left = corpus_pipeline.drop_repeats(spark, shared.Scratch(spark, "test").keep(kept, "kept"), "").where("text <> ''")
    assert Counter(tuple(r) for r in left.collect()) == Counter({k: n for k, n in expected.items() if k[1]})


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs, benchmark = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    scratch, kept = shared.Scratch(spark, "test"), docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, scratch.keep(stage(spark, kept, sf), name)
        assert kept.columns == docs.columns and 0 < kept.count() <= before.count()
        if name == "minhash":
            sets = [minhash.shingle_set(r.text, 5) for r in kept.collect()]
            assert not any(a and 100 * len(a & b) >= 80 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
        if name == "decontamination":
            items = [decontamination.normal(r.text) for r in benchmark.collect()]
            assert not any(i in decontamination.normal(r.text) for r in kept.collect() for i in items)
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, sf)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in kept.select("doc_id").collect()}
