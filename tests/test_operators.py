import json

import pytest
from pyspark.sql import functions as F

from dialoom.functions import text as T
from dialoom.operators import align, checks, export, incremental, judge, metrics, sampling, stats, translate
from dialoom.operators.pairs import Rule, aligned, inferred_rules, text_pairs
from dialoom.sources import tables
from dialoom.streaming.resume import available_records


def pairs(spark, rows, field="text_fr"):
    return spark.createDataFrame([("train", i, 0, field, s, t) for i, (s, t) in enumerate(rows)], "split string, row_idx long, pair_ord int, field string, source string, translation string")


def codes(df):
    return sorted((r.row_idx, r.code) for r in checks.issues_of(df, ["split", "row_idx", "pair_ord", "field"]).collect())


def test_heuristics(spark):
    rows = [
        ("This sentence is clearly long enough to be compared", "Court mais bon"),
        ("This is a sentence of some length for you", "mot " * 60),
        ("Would you like to try this with your friends", "Would you like to try this avec vos amis"),
        ("Bonjour tout le monde ici", "Bonjour &eacute; tout le monde ici la"),
        ("Take [slot-1] now, dear friend of mine", "Prenez [slot-2] maintenant, cher ami"),
        ("Please open the door for me", "Please open the door for me"),
        ("Hello", ""),
        ("https://a.example/b", "https://a.example/b"),
    ]
    found = checks.check_pairs(pairs(spark, rows))
    assert codes(found) == [(0, "length_ratio_low"), (1, "length_ratio_high"), (2, "english_residue"), (3, "html_entity_leak"), (4, "placeholder_or_marker_changed"), (5, "unchanged_translation"), (6, "empty_translation")]
    assert found.where("row_idx = 7").first().suppressed == "url_or_email"


def test_titles_are_suppressed_only_where_allowed(spark):
    rows = [("The Art of the Deal", "The Art of the Deal"), ("what do you want to do today", "what do you want to do today")]
    assert codes(checks.check_pairs(pairs(spark, rows))) == [(0, "unchanged_translation"), (1, "unchanged_translation")]
    assert codes(checks.check_pairs(pairs(spark, rows), title_allowed=True)) == [(1, "unchanged_translation")]


def test_repeated_translation(spark):
    rows = [(f"A rather long and distinct sentence number {w}", "Une seule phrase constante pour tous") for w in ("one", "two", "three", "four", "five")]
    facts = checks.with_facts(pairs(spark, rows, "text_fr[0].content"))
    (r,) = checks.repeated_translations(facts).collect()
    assert (r.root, r.distinct_sources, r.occurrences, r.row_idx) == ("text_fr", 5, 5, 0)
    assert checks.repeated_translations(facts.where("row_idx < 4")).count() == 0


def test_pairs_of_lists_and_structs(spark):
    source = spark.createDataFrame([("train", 0, ["a", "b"], '["x", "y"]', ("q", [("c", "1")]))], "split string, row_idx long, dialog array<string>, history string, turn struct<question:string,answers:array<struct<answer:string,id:string>>>")
    target = spark.createDataFrame([("train", 0, ["c"], '["z", "w"]', ("q2", [("c2", "9")]))], "split string, row_idx long, dialog_fr array<string>, history_fr string, turn_fr struct<question:string,answers:array<struct<answer:string,id:string>>>")
    rows = aligned(source, target)
    found = text_pairs(rows, [Rule("dialog", "dialog_fr"), Rule("history", "history_fr", "serialized_text_list"), Rule("turn", "turn_fr", "deep_map_texts", {"exclude_keys": ["id"]})]).collect()
    assert [(r.field, r.source, r.translation) for r in found if not r.error] == [("dialog_fr[0]", "a", "c"), ("history_fr[0]", "x", "z"), ("history_fr[1]", "y", "w"), ("turn_frquestion", "q", "q2"), ("turn_franswers[0].answer", "c", "c2")]
    assert [(r.field, r.error) for r in found if r.error] == [("dialog_fr", "list length mismatch: 2 != 1")]
    assert inferred_rules(["a", "a_fr", "b_fr"]) == [Rule("a", "a_fr")]


def test_structure(spark):
    source = spark.createDataFrame([("train",), ("train",), ("dev",)], "split string")
    target = spark.createDataFrame([("train",), ("extra",)], "split string")
    assert sorted((r.split, r.code, r.severity) for r in checks.split_issues(source, target).collect()) == [("dev", "split_missing", "error"), ("extra", "split_extra", "warning"), ("train", "row_count_mismatch", "error")]
    assert checks.missing_fields(["a"], ["b"], [Rule("a", "a_fr"), Rule("x", "b")]) == [("translation", "a_fr"), ("source", "x")]


def test_metrics(spark):
    issues = spark.createDataFrame([("train", i, 0, f"dialog_fr[{i}].content", "warning", "new_code", "s", "t") for i in (0, 1, 3)], "split string, row_idx long, pair_ord int, field string, severity string, code string, source string, translation string")
    assert metrics.position_summary(issues).first().positions == "turns 1, 2, 4"
    (g,) = metrics.issue_guide(issues).collect()
    assert (g.rule, g.priority, g.n) == ("New Code", "sample", 3)
    checked = issues.select("field", "split")
    assert metrics.verdict(checked, issues).first().recommendation == "review"


def test_statistics(spark):
    rows = spark.createDataFrame([(6.0, "a", 1), (8.0, "b", 2), (None, "b", 2)], "score double, grp string, n long")
    r = stats.group_means(rows, "grp", "n").first()
    assert (r.balanced_mean, r.weighted_mean) == (7.0, 7.333)
    xy = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 2.0), (3.0, 4.0)], "x double, y double")
    assert stats.spearman(xy, "x", "y").first().spearman == pytest.approx(0.6325, abs=1e-4)
    assert xy.select(F.lit(1.0).alias("x"), "y").agg(stats.pearson("x", "y").alias("p")).first().p is None
    ab = spark.createDataFrame([("p", "p"), ("q", "q"), ("p", "q"), ("q", "q")], "x string, y string")
    assert stats.kappa(ab, "x", "y", ["p", "q"]).first().kappa == 0.5


def test_samples_repeat(spark):
    rows = spark.createDataFrame([("dev" if i % 3 else "test", i // 3 if i % 3 == 0 else i - i // 3 - 1, i % 2) for i in range(60)], "split string, row_idx long, label long")
    one, two = (sorted(map(tuple, sampling.per_split(rows, 5).collect())) for _ in range(2))
    assert one == two and len(one) == 10
    assert sampling.per_split(rows, 0).count() == 60
    assert sampling.stratified(rows, "label", 0).count() == 0
    assert sampling.stratified(rows, "label", 2).count() == 8


def test_reformat(spark):
    source = spark.createDataFrame([("train", 0, "d1", "s1"), ("train", 1, "d1", "s2"), ("train", 2, "d2", "s3"), ("train", 3, "d9", "s4")], "split string, row_idx long, dialogue_id string, text string").withColumn("history", F.array(F.struct(F.lit("user").alias("role"), F.lit("old").alias("content"))))
    external = spark.createDataFrame([("d1", ["u1", "a1", "u2", "a2"]), ("d2", ["u3", "a3"]), ("x", ["u", "a"])], "dialogue_id string, turns array<string>")
    found = sorted(align.reformatted(source, external).collect(), key=lambda r: r.row_idx)
    assert [r.text for r in found] == ["u1", "u2", "u3"] and [r.source_text for r in found] == ["s1", "s2", "s3"]
    assert [(h.role, h.content) for h in found[1].history] == [("user", "u1"), ("assistant", "a1")]
    kept = align.reformatted(source, external, missing="keep_source")
    assert kept.where("row_idx = 3").first().text == "s4"
    r = align.coverage(source, external).first()
    assert (r.covered, r.missing) == (2, 1)


def test_incremental(spark):
    rows = spark.createDataFrame([("a", 1, "status"), ("a", 2, "status"), ("a", 1, "row"), ("a", 2, "row"), ("b", 1, "row"), (None, 5, "row")], "candidate string, attempt int, record_type string")
    assert sorted((r.candidate or "", r.attempt) for r in incremental.compacted(rows).collect()) == [("", 5), ("a", 2), ("a", 2)]
    records = spark.createDataFrame([("s1", 1, "error"), ("s1", 2, " ok "), ("s2", 1, "ok"), ("s2", 2, "error")], "id string, line int, status string")
    tasks = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "id string")
    assert sorted(r.id for r in judge.resumed(tasks, records, ["id"], ["line"]).collect()) == ["s2", "s3"]
    assert incremental.succeeded(records, ["id"]).count() == 2


def test_translation_failures_are_rows(spark):
    def call(text, source, target):
        if text == "bad":
            raise RuntimeError("no")
        return text.upper()

    translate.register_translator("upper", call)
    rows = spark.createDataFrame([("t", 0, "good day"), ("t", 1, "bad"), ("t", 2, ""), ("t", 3, None), ("t", 4, "123")], "split string, row_idx long, text string")
    found = {r.row_idx: (r.text_fr, r.status) for r in translate.translate_column(rows, "text", "text_fr", "upper", guards=[{"kind": "no_letters"}]).collect()}
    assert found == {0: ("GOOD DAY", "ok"), 1: ("bad", "error"), 2: ("", "ok"), 3: (None, "ok"), 4: ("123", "ok")}
    with pytest.raises(ValueError):
        translate.passes_guards(F.col("x"), [{"kind": "other"}])


def test_action_records():
    assert translate.action_records("User: a\nmore\nAgent: say(x)\nclick(1)") == ["User: a\nmore", "Agent: say(x)", "click(1)"]
    assert translate.action_records("") == []


def test_export(spark):
    rows = spark.createDataFrame([('[{"role":"u","content":"a"}]', '[{"content_fr":"b"},{"content_fr":"c"}]')], "q string, q_fr string")
    found = export.reshape(rows, [("serialized_dialog_content", {"source": "q", "translated": "q_fr"}), ("drop_columns", {"columns": ["q_fr", "none"]})])
    assert found.columns == ["q"] and json.loads(found.first().q) == [{"role": "u", "content": "b"}]
    with pytest.raises(ValueError):
        export.reshape(rows, [("unknown", {})])


def test_sources(spark, tmp_path):
    rows = spark.createDataFrame([("train", 0, "a"), ("dev", 0, "b")], "split string, row_idx long, x string")
    tables.write_splits(rows, str(tmp_path / "t"))
    assert tables.read_source(spark, "disk", str(tmp_path / "t"), max_rows=1).count() == 2
    with pytest.raises(FileNotFoundError):
        tables.read_source(spark, "disk")
    assert tables.read_records(spark, str(tmp_path / "none"), "a int").count() == 0
    a, b = (sorted(map(tuple, tables.fingerprints(df).collect())) for df in (rows, rows.orderBy("x", ascending=False)))
    assert a == b
    assert {r.split for r in tables.renamed_splits(rows, {"dev": "test"}).collect()} == {"train", "test"}


def test_records_as_a_stream(spark, tmp_path):
    schema = "id string, line int, status string"
    for n, rows in enumerate(([("a", 1, "error")], [("a", 2, "ok"), ("b", 3, "ok")])):
        spark.createDataFrame(rows, schema).write.mode("append").json(str(tmp_path / "in"))
        found = available_records(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "ck"), ["id"], ["line"])
        assert found.count() == n + 1
    assert {r.id: r.status for r in found.collect()} == {"a": "ok", "b": "ok"}


def test_blank_and_strip(spark):
    df = spark.createDataFrame([("  \t",), (" a ",)], "x string")
    assert [r.b for r in df.select(T.is_blank(F.col("x")).alias("b")).collect()] == [True, False]


def test_export_files(spark, tmp_path):
    rows = spark.createDataFrame([("train", 1, "b"), ("train", 0, "a"), ("dev", 0, "c")], "split string, row_idx long, x string")
    assert tables.export_splits(rows, str(tmp_path / "e")) == {"train": 2, "dev": 1}
    assert [r.x for r in spark.read.parquet(str(tmp_path / "e/train-00000-of-00001.parquet")).collect()] == ["a", "b"]
    assert "path: default/train-*.parquet" in tables.front_matter({"default": ["train"]})


def test_quoted_values():
    assert translate.quoted_value('""a "b" c"" rest') == ('a "b" c', 11)
    assert translate.quoted_value("x='it\\'s' y", 2) == ("it\\'s", 9)
    assert translate.quoted_value("none") is None
    call = lambda t, a, b: f"{b}:{t}"
    assert translate.with_utterance('Agent: say(speaker="x", utterance="hi")', call, ("en", "fr")) == 'Agent: say(speaker="x", utterance="fr:hi")'


def test_unchanged_translations_are_errors(spark):
    translate.register_translator("same", lambda text, source, target: text)
    rows = spark.createDataFrame([("t", 0, "Please open the door for me"), ("t", 1, "Paris")], "split string, row_idx long, text string")
    found = {r.row_idx: r.error for r in translate.translate_column(rows, "text", "text_fr", "same", unchanged_is_error=True).collect()}
    assert found == {0: "unchanged translation", 1: ""}
