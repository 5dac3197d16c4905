import json

import pytest
from pyspark.sql import functions as F

from dialoom.operators import nested, strategies, translate
from dialoom.operators.pairs import Rule, aligned, text_pairs


def swap(text):
    return text.replace("e", "3").replace("a", "4")


def rows(spark, values, kind):
    return spark.createDataFrame([("s", i, v) for i, v in enumerate(values)], f"split string, row_idx long, x {kind}")


def one(spark, values, kind, strategy, translator="letters", **options):
    done = strategies.translated(rows(spark, values, kind), [Rule("x", "y", strategy, options)], translator)
    return [(r.y, r.status, r.error) for r in done.orderBy("row_idx").collect()]


def test_text(spark):
    long = "an apple a day, " * 400
    assert one(spark, ["bear", "", None, " \n", long], "string", "text", max_chunk_chars=100) == [("b34r", "ok", ""), ("", "ok", ""), (None, "ok", ""), (" \n", "ok", ""), (swap(long), "ok", "")]


def test_lists(spark):
    lists = [["bear", "ape"], [], None, ["bear", ""], [None, "a"], ["a" * 60, "e" * 60, "tea"], ["e" * 300]]
    expected = [["b34r", "4p3"], [], None, ["b34r", ""], ["", "4"], ["4" * 60, "3" * 60, "t34"], ["3" * 300]]
    assert [x[0] for x in one(spark, lists, "array<string>", "text_list", max_chunk_chars=100)] == expected
    texts = [json.dumps(x) for x in lists if x is not None] + ["{", '{"a": 1}', '[{"a": 1}]', '[1, null, "e"]']
    found = one(spark, texts, "string", "serialized_text_list", max_chunk_chars=100)
    assert [json.loads(y) for y, _, _ in found[:6]] == [x for x in expected if x is not None]
    assert [(y, s) for y, s, _ in found[6:9]] == [(t, "error") for t in texts[6:9]] and json.loads(found[9][0]) == ["1", "", "3"]


def test_damaged_markers(spark):
    """A service that loses markers, and one that fails for some texts."""
    translate.register_translator("eats markers", lambda text, s, t: text.replace("@@", "").upper())
    assert one(spark, [["b", "c"], ["d"]], "array<string>", "text_list", "eats markers") == [(["B", "C"], "ok", ""), (["D"], "ok", "")]

    def fails(text, s, t):
        if "bad" in text:
            raise RuntimeError("no")
        return text.upper()

    translate.register_translator("fails", fails)
    (first, second) = one(spark, [["ok", "bad"], ["fine"]], "array<string>", "text_list", "fails")
    assert first[:2] == (["OK", "bad"], "error") and "item 1" in first[2] and second == (["FINE"], "ok", "")


def test_batches(spark):
    items = [["aa"] * 30, ["b" * 50], [], ["c", "d" * 40, "e"]]
    found = rows(spark, items, "array<string>").select("row_idx", strategies.marked_batches(F.col("x"), 40).alias("b"), "x").orderBy("row_idx").collect()
    for r in found:
        assert [y for batch in r.b for y in batch] == r.x
        for batch in r.b:
            assert len(batch) == 1 or len("\n".join(f"@@{i}@@ {y}" for i, y in enumerate(batch))) <= 40
        for left, right in zip(r.b, r.b[1:], strict=False):  # greedy: the next item has no room
            assert len("\n".join(f"@@{i}@@ {y}" for i, y in enumerate([*left, right[0]]))) > 40


def test_dialogues(spark):
    turn = "array<struct<role:string,content:string>>"
    found = one(spark, [[("u", "an\nape "), ("s", None)], [], None], turn, "dialog_turns_content")
    assert [[tuple(t) for t in y] if y is not None else None for y, _, _ in found] == [[("u", "4n 4p3"), ("s", "")], [], None]
    kept = one(spark, [[("u", "an\nape ")]], turn, "dialog_turns_content", normalize_newlines=False)
    assert kept[0][0][0].content in ("4n\n4p3 ", "4n\n4p3")
    source = ['[{"role": "u", "n": 1, "content": "ape"}, {"content": null, "z": {"k": [1, null]}}]', "[1]", "no", '[{"role": "u"}]']
    found = one(spark, source, "string", "serialized_dialog_turns_content", target_content_field="fr")
    assert json.loads(found[0][0]) == [{"role": "u", "n": 1, "content": "ape", "fr": "4p3"}, {"content": None, "z": {"k": [1, None]}, "fr": ""}]
    assert [(y, s) for y, s, _ in found[1:]] == [(x, "error") for x in source[1:]]


def test_entities(spark):
    found = one(spark, ["name <S> tea <S> a bear <S> x", "plain tea", "n <S> t <S>  ", None], "string", "structured_entity")
    assert [y for y, _, _ in found] == ["name <S> tea <S> 4 b34r <S> x", "pl4in t34", "n <S> t <S>  ", None]


NESTED = "struct<q:string,id:string,answers:array<struct<text:string,note:string,n:int,more:array<struct<t:string>>>>,tags:array<string>>"
VALUE = ("area", "ea", [("bear", None, 3, [("tea",), (None,)]), (None, "sea", 4, None), None], ["ape", "", None])


def test_nested(spark):
    paths = ["answers[].text", "q", "answers[].more[].t", "absent.x", "q", "tags[]"]
    done = one(spark, [VALUE, None], NESTED, "nested_text_fields", paths=paths)
    y = done[0][0]
    assert (y.q, y.id, y.tags) == ("4r34", "ea", ["ape", "", None]) and done[1][0] is None
    assert [(a.text, a.note, a.n, a.more and [m.t for m in a.more]) if a else None for a in y.answers] == [("b34r", None, 3, ["t34", None]), (None, "sea", 4, None), None]
    deep = one(spark, [VALUE, None], NESTED, "deep_map_texts", exclude_keys=["id", "note"])[0][0]
    assert (deep.q, deep.id, deep.tags, deep.answers[1].note, deep.answers[0].more[0].t) == ("4r34", "ea", ["4p3", "", None], "sea", "t34")


def test_nested_pairs(spark):
    source = rows(spark, [VALUE, VALUE], NESTED)
    target = source.withColumn("x_fr", F.when(F.col("row_idx") == 0, F.col("x")).otherwise(F.col("x").withField("answers", F.slice("x.answers", 1, 1)))).drop("x")
    found = text_pairs(aligned(source, target), [Rule("x", "x_fr", "nested_text_fields", {"paths": ["answers[].text", "q", "answers[].more[].t"]})]).orderBy("row_idx", "pair_ord").collect()
    assert [(r.field, r.source) for r in found if r.row_idx == 0] == [("x_fr.answers[0].text", "bear"), ("x_fr.answers[1].text", ""), ("x_fr.q", "area"), ("x_fr.answers[0].more[0].t", "tea"), ("x_fr.answers[0].more[1].t", "")]
    assert [r.error for r in found if r.row_idx == 1 and r.error] == ["nested path count mismatch: 5 -> 4"]
    assert nested.segments("[].a.b[].c") == ["[]", "a", "b", "[]", "c"]


def test_unchanged_texts_are_sent_again(spark):
    translate.register_translator("stuck", lambda text, s, t: text, again=lambda text, s, t: "changed" if "please" in text else text)
    texts = ["please send the report to me", "where is the station for trains", "ok"]
    found = one(spark, texts, "string", "text", "stuck", retry_unchanged=True)
    assert found == [("changed", "ok", ""), (texts[1], "error", "item 0: unchanged translation"), ("ok", "ok", "")]
    assert [s for _, s, _ in one(spark, texts, "string", "text", "stuck")] == ["ok"] * 3


def test_problems_come_before_any_row(spark):
    source = rows(spark, ["a"], "string").withColumn("l", F.array("x"))
    for rule, said in ((Rule("x", "y", "none"), "unknown"), (Rule("z", "y", "text"), "missing"), (Rule("l", "y", "text"), "scalar"), (Rule("x", "y", "text_list"), "list"), (Rule("x", "y", "dialog_turns_content"), "turns"), (Rule("l", "y", "nested_text_fields"), "paths"), (Rule("x", "y", "deep_map_texts"), "mapping"), (Rule("l", "y", "structured_entity"), "string")):
        with pytest.raises(ValueError, match=said):
            strategies.translated(source, [rule], "letters")


def test_several_rules_limits_and_dropped_columns(spark):
    source = rows(spark, ["ape", "{", "bear"], "string").withColumn("j", F.when(F.col("row_idx") == 1, "{").otherwise('["e"]'))
    done = strategies.translated(source, [Rule("x", "x_fr", "text"), Rule("j", "j", "serialized_text_list")], "letters", limit=2, drop=("x", "j"))
    assert done.columns == ["split", "row_idx", "j", "x_fr", "status", "error", "attempts"]
    assert [(r.x_fr, r.j, r.status) for r in done.orderBy("row_idx").collect()] == [("4p3", '["3"]', "ok"), ("{", "{", "error")]
    assert strategies.translated(source.limit(0), [Rule("x", "x_fr", "text")], "letters").count() == 0


def test_requests_are_moved_once_and_go_to_bounded_tasks(spark, monkeypatch, tmp_path):
    from dialoom.operators import answers as A
    from dialoom.operators.translate import translate_distinct

    texts = spark.range(200).selectExpr("cast(id % 100 as string) as text")
    dealt = translate_distinct(texts, "letters", parts=4)
    assert dealt._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    assert sorted(int(r.text) for r in dealt.collect()) == list(range(100))
    monkeypatch.setattr(A, "REQUESTS", 1)
    monkeypatch.setattr(A, "MOST_TASKS", 10)
    log = A.AnswerLog(spark, str(tmp_path / "answers"))
    assert log.ask(texts, "letters").count() == 100
    assert len(list((tmp_path / "answers").glob("*/*.parquet"))) <= 10


def test_texts_are_moved_few_times(spark, tmp_path):
    """What one text rule leaves on disk, answers and shuffled files together, is a few times its texts."""
    import os
    import random

    from dialoom.operators.answers import AnswerLog

    draw = random.Random(1)
    texts = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz0123456789 ", k=9000)) for _ in range(600)]
    on_disk = lambda top: sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(top) for f in files)
    local = [x.getPath() for x in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    before = sum(map(on_disk, local))
    done = strategies.translated(rows(spark, texts, "string"), [Rule("x", "y", "text")], "letters", answers=AnswerLog(spark, str(tmp_path / "log")))
    assert done.select("row_idx", "y").where("y like '%3%'").count() == 600
    assert sum(map(on_disk, local)) - before + on_disk(tmp_path) < 4 * sum(map(len, texts))


def test_texts_with_lists_blanks_and_copies(spark, tmp_path):
    """Texts, blank or not, in pieces or not, beside lists: equal requests are sent once, and pieces come back in order."""
    from dialoom.operators.answers import AnswerLog

    texts = ["bear", "bear", None, "", " " * 50, "a" * 25 + " " * 30 + "e" * 7, "e\U0001f600a " * 9, "bear tea", "a b " * 100]
    source = rows(spark, texts, "string").withColumn("l", F.array("x", F.lit(" ")))
    log = AnswerLog(spark, str(tmp_path / "log"))
    done = strategies.translated(source, [Rule("x", "y", "text", {"max_chunk_chars": 10}), Rule("l", "m", "text_list")], "letters", answers=log)
    assert [(r.y, r.m, r.status) for r in done.orderBy("row_idx").collect()] == [(t and swap(t), [swap(t or ""), " "], "ok") for t in texts]
    asked = log.rows().count()
    assert asked == log.rows().select("key").distinct().count()
    alone = strategies.translated(source, [Rule("x", "x", "text", {"max_chunk_chars": 10})], "letters", answers=log)
    assert [r.x for r in alone.orderBy("row_idx").collect()] == [t and swap(t) for t in texts] and log.rows().count() == asked
