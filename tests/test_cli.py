import json

import pytest
from pyspark.sql import functions as F

from dialoom import cli, config
from dialoom.operators import audit, report


def test_check_end_to_end(spark, tmp_path):
    source = spark.createDataFrame([("validation", i, t) for i, t in enumerate(["Please open the door for me", "Hello there my friend", "a"])], "split string, row_idx long, text string")
    target = spark.createDataFrame([("dev", i, t) for i, t in enumerate(["Please open the door for me", "", "b"])], "split string, row_idx long, text_fr string")
    source.write.parquet(str(tmp_path / "s"))
    target.write.parquet(str(tmp_path / "t"))
    (tmp_path / "c.json").write_text(json.dumps({"rules": [{"source": "text", "target": "text_fr"}], "split_map": {"validation": "dev"}}))
    arguments = ["check", "--config", str(tmp_path / "c.json"), "--source", str(tmp_path / "s"), "--translated", str(tmp_path / "t"), "--out", str(tmp_path / "o")]
    assert cli.main(arguments) == 1
    found = json.loads((tmp_path / "o/summary.json").read_text())
    assert (found["checked_pairs"], found["errors"], found["warnings"], found["verdict"]) == (3, 1, 1, "fail")
    assert found["splits_differ"] == [] and "Unchanged English text" in (tmp_path / "o/report.html").read_text()


def test_check_reports_broken_values_actions_and_repeats(spark, tmp_path):
    long = [f"This sentence number {w} is about something quite different from all the others" for w in ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten")]
    kind = "split string, row_idx long, turns array<string>, js string, query string, x array<string>, said string"
    source = [("train", i, ["a", "b"] if i else ["a"], '["a"]', "click(1)", ["a"], t) for i, t in enumerate(long)]
    target = [("train", i, ["c"], "no list" if i == 1 else '["c"]', "load(1)" if i == 2 else "click(1)", "c", "Cette phrase revient toujours la même, quelle que soit la source") for i in range(len(long))]
    spark.createDataFrame(source, kind).write.parquet(str(tmp_path / "s"))
    spark.createDataFrame(target, kind.replace("x array<string>", "x string")).write.parquet(str(tmp_path / "t"))
    strategies = {"js": "serialized_text_list", "query": "weblinx_query"}
    rules = [{"source": c, "target": c, "strategy": strategies.get(c, "auto")} for c in ("turns", "js", "query", "x", "said")]
    (tmp_path / "c.json").write_text(json.dumps({"rules": rules}))
    assert cli.main(["check", "--config", str(tmp_path / "c.json"), "--source", str(tmp_path / "s"), "--translated", str(tmp_path / "t"), "--out", str(tmp_path / "o")]) == 1
    found = json.loads((tmp_path / "o/summary.json").read_text())
    codes = {c["key"]: c["n"] for c in found["counts"] if c["kind"] == "code"}
    assert (codes["list_length_mismatch"], codes["field_type_mismatch"], codes["weblinx_action_changed"], codes["repeated_translation"]) == (9, 11, 1, 1)
    assert found["errors"] == 21


def test_config_is_checked():
    with pytest.raises(ValueError):
        config.from_mapping({"rules": [{"source": "a", "target": "b"}, {"source": "c", "target": "b"}]})
    with pytest.raises(ValueError):
        config.from_mapping({"rules": [], "other": 1})
    with pytest.raises(ValueError):
        config.RunPolicy(concurrency=0)


def test_audit(spark):
    plan = spark.createDataFrame([("d", "fr", "train", "source_compare", ""), ("d", "ru", "train", "self_suffix", ""), ("e", "fr", "train", "metadata_only", "n")], "dataset string, lang string, target_split string, mode string, note string")
    changed = audit.excluded(plan, ["d:ru,es"])
    assert sorted((r.mode, r.n) for r in audit.mode_counts(changed).collect()) == [("excluded", 1), ("metadata_only", 1), ("source_compare", 1)]
    issues = spark.createDataFrame([("d", "fr", "train", i, "c1", "warning", "f", "s", "t") for i in (0, 0, 2)], "dataset string, lang string, target_split string, row_idx long, code string, severity string, field string, source string, translation string")
    rows = spark.createDataFrame([("d", "fr", "train", 8)], "dataset string, lang string, target_split string, rows long")
    found = {(r.dataset, r.lang): r for r in audit.audit_summary(changed, audit.task_results(issues, ["dataset", "lang", "target_split"]), rows).collect()}
    assert (found["d", "fr"].pct, found["d", "fr"].status, found["d", "ru"].status, found["e", "fr"].status) == (25.0, "warnings", "excluded", "metadata_only")
    pairs = spark.createDataFrame([("a->b; c -> d",)], "x string").select(audit.column_pairs(F.col("x")).alias("p")).first().p
    assert [tuple(p) for p in pairs] == [("a", "b"), ("c", "d")]


def test_rendering(spark):
    rows = spark.createDataFrame([(["a", None],)], "x array<string>")
    assert rows.select(report.rendered(F.col("x"), "text_list").alias("y")).first().y == "1. a\n2. "
    assert report.percent(1, 100_000) == "<0.01%" and report.percent(1, 0) == "n/a"
    with pytest.raises(ValueError):
        report.rendered(F.col("x"), "other")


def saved(folder, name, payload):
    import json

    at = folder / name
    at.parent.mkdir(parents=True, exist_ok=True)
    at.write_text(json.dumps(payload), encoding="utf-8")
    return str(at)


def test_translate_and_check(spark, tmp_path, capsys):
    rows = [("train", 0, "a bear here", ["tea", "sea"]), ("train", 1, "more tea please now", []), ("test", 0, "ape", None)]
    spark.createDataFrame(rows, "split string, row_idx long, text string, turns array<string>").write.parquet(str(tmp_path / "source"))
    spark.createDataFrame([("spare", 0, "x")], "split string, row_idx long, text string").write.parquet(str(tmp_path / "other"))
    rules = [{"source": "text", "target": "text_fr", "strategy": "text"}, {"source": "turns", "target": "turns_fr", "strategy": "text_list"}]
    settings = {"rules": rules, "translator": "letters", "passthrough": [{"path": str(tmp_path / "other"), "source_split": "spare", "output_split": "more"}]}
    file = saved(tmp_path, "d.json", settings)
    assert cli.main(["translate", "--config", file, "--source", str(tmp_path / "source"), "--out", str(tmp_path / "out")]) == 0
    done = {(r.split, r.row_idx): (r.text_fr, r.turns_fr) for r in spark.read.parquet(str(tmp_path / "out" / "dataset")).collect()}
    assert done == {("train", 0): ("4 b34r h3r3", ["t34", "s34"]), ("train", 1): ("mor3 t34 pl34s3 now", []), ("test", 0): ("4p3", None), ("more", 0): (None, None)}
    from dialoom.sources import tables

    found = tables.read_manifest(str(tmp_path / "out"))
    assert found["kind"] == "translation" and set(found["fingerprints"]) == {"train", "test"} and tables.read_manifest(str(tmp_path)) is None
    assert cli.main(["check", "--config", file, "--source", str(tmp_path / "source"), "--translated", str(tmp_path / "out" / "dataset"), "--out", str(tmp_path / "check")]) in (0, 1)
    assert spark.read.parquet(str(tmp_path / "check" / "metrics")).where("normal_field = 'text_fr'").first().checked_pairs == 3
    assert cli.main(["check", "--infer", "fr", "--translated", str(tmp_path / "out" / "dataset"), "--out", str(tmp_path / "check2"), "--max-rows-per-split", "1"]) in (0, 1)
    assert spark.read.parquet(str(tmp_path / "check2-sample-1" / "metrics")).count() > 0
    with pytest.raises(SystemExit):
        cli.main(["check", "--translated", "x", "--out", "y"])
    # a failing service: records are kept, nothing else is written
    from dialoom.operators import translate

    def fails(text, *_):
        raise OSError("down")

    translate.register_translator("down", fails)
    args = ["translate", "--config", file, "--set", "translator=down", "--set", "policy.retries=1", "--set", "policy.sleep=0", "--source", str(tmp_path / "source"), "--out", str(tmp_path / "bad")]
    assert cli.main(args) == 1 and "test, train" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "bad" / "records")).count() == 3 and not (tmp_path / "bad" / "dataset").exists()
    assert cli.main([*args, "--set", "policy.allow_errors=true"]) == 0


def test_evaluate_and_benchmark(spark, tmp_path):
    import json

    rows = [("train", i, f"text {i}", f"texte {i}", "ab"[i % 2]) for i in range(12)]
    spark.createDataFrame(rows, "split string, row_idx long, text string, text_fr string, kind string").write.parquet(str(tmp_path / "t"))
    payload = {
        "inputs": {"translation": {"kind": "path", "path": str(tmp_path / "t")}}, "sample_dataset": "translation", "stratify_by": "kind", "samples": 2,
        "field_pairs": [{"source_dataset": "translation", "source_field": "text", "translation_dataset": "translation", "translation_field": "text_fr"}],
    }
    file = saved(tmp_path, "e.json", payload)
    for _ in range(2):  # the second time there is nothing to do
        assert cli.main(["evaluate", "--config", file, "--out", str(tmp_path / "e")]) == 0
    records = spark.read.parquet(str(tmp_path / "e" / "records"))
    assert records.count() == 4 and {r._run for r in records.collect()} == {1}
    assert json.loads((tmp_path / "e" / "summary.json").read_text())["statuses"] == [{"status": "ok", "n": 4}]
    bad = saved(tmp_path, "bad.json", {**payload, "stratify_by": "absent"})
    assert cli.main(["evaluate", "--config", bad, "--out", str(tmp_path / "x")]) == 1

    rows = [(i, "en-fr" if i % 2 else "en-de", f"source {'x' * (i % 7)}", f"target {'y' * (i % 11)}", float(i * 13 % 101)) for i in range(40)]
    spark.createDataFrame(rows, "dataset_idx long, lp string, src string, mt string, score double").write.parquet(str(tmp_path / "b"))
    file = saved(tmp_path, "b.json", {"models": ["m1", "m2"], "per_pair": 8, "sampling_thresholds": [50]})
    assert cli.main(["benchmark-judge", "--config", file, "--rows", str(tmp_path / "b"), "--out", str(tmp_path / "bo")]) == 0
    found = json.loads((tmp_path / "bo" / "summary.json").read_text())["models"]
    assert [(r["model"], r["lp"], r["rows"], r["n"]) for r in found] == [(m, lp, 16, n) for m in ("m1", "m2") for lp, n in ((None, 16), ("en-de", 8), ("en-fr", 8))]


def test_reformat_fix_and_upload(spark, tmp_path, capsys):
    import json

    rows = [("train", i, f"d{i // 2}", f"u{i}", [("user", "old")]) for i in range(4)]
    spark.createDataFrame(rows, "split string, row_idx long, dialogue_id string, text string, history array<struct<role:string,content:string>>").write.parquet(str(tmp_path / "s"))
    log = lambda n: {"log": [{"text": f"t{i}"} for i in range(n)]}
    saved(tmp_path, "ext/good.json", {"d0": log(4), "d1": log(3), "z": log(2)})
    (tmp_path / "ext" / "broken.json").write_text("no")
    file = saved(tmp_path, "r.json", {"root": str(tmp_path / "ext"), "candidates": {"good": "good.json"}})
    assert cli.main(["inspect", "--config", file, "--source", str(tmp_path / "s"), "--out", str(tmp_path / "i")]) == 0
    summary = json.loads(spark.read.parquet(str(tmp_path / "i" / "candidates")).first().summary)
    assert (summary["common"], summary["external_only"], summary["first_text"]) == (2, 1, "t0")
    assert cli.main(["reformat", "--config", file, "--source", str(tmp_path / "s"), "--out", str(tmp_path / "r")]) == 0
    assert sorted((r.row_idx, r.text, r.source_text) for r in spark.read.parquet(str(tmp_path / "r" / "good")).collect()) == [(0, "t0", "u0"), (1, "t2", "u1")]
    split = json.loads(spark.read.parquet(str(tmp_path / "r" / "candidates")).first().summary)["splits"][0]
    assert (split["source_rows"], split["output_rows"], split["missing"], split["bad"], split["bad_ids"]) == (4, 2, 0, 1, ["d1"])
    missing = saved(tmp_path, "m.json", {"root": str(tmp_path / "ext"), "candidates": {"none": "none.json"}})
    assert cli.main(["reformat", "--config", missing, "--source", str(tmp_path / "s"), "--out", str(tmp_path / "m")]) == 1

    from dialoom.operators import judge

    judge.JUDGES["fixer"] = lambda prompt: '```json\n{"suggested_translation": "mieux", "confidence": 1.4, "rationale": "r"}\n```'
    issues = [("warning", "english_residue", "train", i, "text_fr", "a  b", "c", 2) for i in range(3)] + [("warning", "length_ratio_low", "train", 9, "x", "s", "t", 1), ("warning", "english_residue", "train", 5, "x", "s", " ", 1)]
    spark.createDataFrame(issues, "severity string, code string, split string, row_idx long, field string, source string, translation string, duplicate_count int").write.parquet(str(tmp_path / "issues"))
    assert cli.main(["check-fix", "--issues", str(tmp_path / "issues"), "--judge", "fixer", "--out", str(tmp_path / "f")]) == 0
    (r,) = spark.read.parquet(str(tmp_path / "f" / "suggestions")).collect()
    assert (r.suggestion_id, r.suggestion, r.confidence, r.occurrences, r.status) == ("train:0:text_fr:english_residue", "mieux", 1.0, 6, "ok")

    upload = {"repo": "me/x", "source": {"path": str(tmp_path / "s")}, "export": {"transforms": [{"name": "drop_columns", "columns": ["history"]}]}}
    saved(tmp_path, "conf/uploads/u.json", upload)
    assert cli.main(["upload", "--root", str(tmp_path / "conf"), "--all", "--out", str(tmp_path / "u"), "--push", "--yes"]) == 0
    assert "u: 4 rows" in capsys.readouterr().out and spark.read.parquet(str(tmp_path / "u" / "u" / "default" / "train-00000-of-00001.parquet")).columns == ["dialogue_id", "text"]
    with pytest.raises(PermissionError):
        cli.main(["upload", "--root", str(tmp_path / "conf"), "--upload", "u", "--out", str(tmp_path / "u"), "--push"])
    with pytest.raises(SystemExit):
        cli.main(["upload", "--root", str(tmp_path / "conf"), "--upload", "none", "--out", str(tmp_path / "u")])


def test_audit_of_a_plan(spark, tmp_path, capsys):
    """Tasks at once, a missing split and a failing task as records, taken up where it was, and the summary."""
    data = tmp_path / "data"
    texts = ["please open the door for me", "a quiet evening at the house", "where is the station"]
    for split in ("train", "test"):
        both = [(t, t if split == "test" and i == 1 else f"phrase numéro {i}", ["a"]) for i, t in enumerate(texts)]
        spark.createDataFrame(both, "text string, text_fr string, l array<string>").coalesce(1).write.parquet(str(data / "org/d/default" / split))
    spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).write.parquet(str(data / "org/src/en/all"))
    head = "dataset,lang,mode,target_repo,target_config,target_split,pairs,source_repo,source_config,source_split,note"
    tasks = [
        "D,fr,self_suffix,org/d,default,train,text->text_fr,,,,", "D,fr,self_suffix,org/d,default,test,text->text_fr,,,,", "D,fr,source_compare,org/d,default,test,text->text_fr,org/src,en,all,",
        "E,fr,source_compare,org/none,default,train,text->text_fr,org/src,en,all,", "F,fr,self_suffix,org/d,default,train,nothing->text_fr,,,,", "G,ru,metadata_only,,,,,,,,by hand", "H,fr,self_suffix,org/d,default,train,text->text_fr,,,,",
    ]
    (tmp_path / "plan.csv").write_text("\n".join([head, *tasks[:2], *tasks[3:]]) + "\n")
    arguments = ["audit", "--plan", str(tmp_path / "plan.csv"), "--data", str(data), "--out", str(tmp_path / "o"), "--exclude", "H:fr", "--at-once", "3"]
    assert cli.main([*arguments, "--limit-tasks", "1"]) == 0
    assert len(list((tmp_path / "o/tasks").glob("*.json"))) == 1
    assert cli.main(arguments) == 1
    said = capsys.readouterr().out
    assert "D fr default/test: rows=3 issue_rows=1" in said and "missing_split: FileNotFoundError" in said and "F fr default/train: failed: ValueError" in said
    rows = {r["dataset"]: r for r in json.loads((tmp_path / "o/quality_summary.json").read_text())}
    assert (rows["D"]["rows"], rows["D"]["issue_rows"], rows["D"]["status"], rows["G"]["status"], rows["H"]["status"]) == (6, 1, "warnings", "metadata_only", "excluded")
    assert rows["D"]["examples"][0]["row_idx"] == 1
    # what failed is done again, what was done or missing is not
    assert cli.main(arguments) == 1 and capsys.readouterr().out.count("\n") == 1


def test_tasks_of_an_audit_overlap(spark):
    import threading

    plan = spark.createDataFrame([(i, "d", "fr", "self_suffix", "r", "c", f"s{i}") for i in range(2)], "plan_ord int, dataset string, lang string, mode string, target_repo string, target_config string, target_split string")
    done = spark.createDataFrame([], "dataset string, lang string, target_repo string, target_config string, target_split string, status string")
    both = threading.Barrier(2, timeout=20)
    found = audit.run_audit(plan, done, lambda task: {"n": both.wait() * 0}, at_once=2)
    assert [r["status"] for r in found] == ["ok", "ok"]


def test_rows_of_files_are_numbered(spark, tmp_path):
    from dialoom.sources import tables

    for i, n in enumerate((5, 0, 7)):
        spark.range(10 * i, 10 * i + n).coalesce(1).write.parquet(str(tmp_path / "x"), mode="append")
    found = tables.numbered_files(spark.read.parquet(str(tmp_path / "x"))).select("id", "row_idx").collect()
    assert sorted(r.row_idx for r in found) == list(range(12))
    ordered = [r.id for r in sorted(found, key=lambda r: r.row_idx)]
    assert ordered in ([*range(5), *range(20, 27)], [*range(20, 27), *range(5)])
