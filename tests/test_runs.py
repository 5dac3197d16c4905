import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dialoom import config
from dialoom.functions import scoring as S
from dialoom.operators import audit, checks, evaluation, incremental, judge, metrics, runs, sampling, stats, translate
from dialoom.operators.pairs import keyed


def test_retries_and_limits():
    waits = []
    calls = iter([OSError("a"), ValueError("b"), "done"])

    def operation():
        x = next(calls)
        if isinstance(x, Exception):
            raise x
        return x

    assert runs.RetryPolicy(2, 1.0).call(operation, waits.append) == ("done", 3, "")
    assert 1 <= waits[0] <= 2 and 2 <= waits[1] <= 3
    assert max(runs.RetryPolicy(9, 1.0).wait(9, random.Random(i)) for i in range(20)) == 8
    assert runs.RetryPolicy(1).call(lambda: 1 / 0, waits.append) == (None, 2, "ZeroDivisionError: division by zero")
    now = [0.0]
    limit = runs.RateLimit(6, 2, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    for _ in range(7):
        limit.enter()
    assert (limit.waits, limit.seconds) == (2, 120.0)


def test_services_fail_by_the_row(spark):
    judge.JUDGES["odd"] = lambda prompt: 1 / 0 if prompt == "bad" else '{"score": 5}'
    rows = spark.createDataFrame([("bad",), ("good",)], "prompt string")
    found = {r.prompt: (r.status, r.score, r.attempts) for r in judge.judged(rows, "odd", retries=2, concurrency=2).collect()}
    assert found == {"bad": ("error", None, 3), "good": ("ok", 5.0, 1)}
    with pytest.raises(ValueError, match="more than"):
        judge.tasks(rows, spark.range(judge.SHORT_LIST + 1))
    done = translate.translate_distinct(spark.createDataFrame([("a",), ("a",), (None,)], "text string"), "letters", concurrency=3, per_minute=1000).collect()
    assert [(r.text, r.translation, r.attempts) for r in done] == [("a", "4", 1)]


def test_records_are_taken_up_again(spark, tmp_path):
    tasks = spark.createDataFrame([(i,) for i in range(6)], "id long")
    path, seen = str(tmp_path / "r"), []

    def process(bad):
        def run(todo):
            seen.append(sorted(r.id for r in todo.collect()))
            return todo.withColumn("status", F.when(F.col("id").isin(bad), "error").otherwise("ok"))

        return run

    runs.run_records(spark, tasks, path, ["id"], process([2, 4]))
    found = runs.run_records(spark, tasks, path, ["id"], process([4]))
    assert seen == [[0, 1, 2, 3, 4, 5], [2, 4]]
    assert {r.id: (r.status, r._run) for r in found.collect()} == {0: ("ok", 1), 1: ("ok", 1), 2: ("ok", 2), 3: ("ok", 1), 4: ("error", 2), 5: ("ok", 1)}


def test_candidates(spark, tmp_path):
    path, fails = str(tmp_path / "c"), {"b"}

    def process(name, where):
        if name in fails:
            raise OSError("no")
        return {"at": where}, spark.createDataFrame([(1,)], "x long")

    assert runs.run_candidates(spark, {"a": "1", "b": "2"}, path, process) == {"a": "ok", "b": "error"}
    fails.clear()
    assert runs.run_candidates(spark, {"a": "1", "b": "2"}, path, process) == {"a": "ok", "b": "ok"}
    rows = spark.read.parquet(path).collect()
    assert Counter((r.candidate, r.attempt, r.record_type, r.status) for r in rows) == Counter([("a", 1, "status", "ok"), ("a", 1, "detail", "ok"), ("b", 2, "status", "ok"), ("b", 2, "detail", "ok")])


def test_gates_and_batches(spark):
    records = spark.createDataFrame([("a", 0, "x", "ok", ""), ("a", 1, None, "ok", ""), ("b", 0, "y", "error", "down")], "split string, row_idx long, t string, status string, error string")
    with pytest.raises(RuntimeError, match="b"):
        runs.gated(records, False)
    assert runs.gated(records, True) == ["b"]
    rows = records.select("split", "row_idx", F.lit("s").alias("s"))
    with pytest.raises(ValueError, match="a 1, b 1"):
        runs.materialised(rows, runs.restored(records, ["t"]), ["t"])
    assert runs.row_batches({"a": 5, "b": 0, "c": 2}, 2, spark.createDataFrame([("a", 0), ("a", 1), ("c", 0)], "split string, row_idx long")) == [("a", 2, 4), ("a", 4, 5), ("c", 0, 2)]


def benchmark_by_force(rows, per_pair, total, thresholds, seed):
    """Rows (idx, lp, score) drawn with lists in memory."""
    bin_of = lambda s: next((f"bin_{i}" for i, t in enumerate(thresholds) if s < t), f"bin_{len(thresholds)}")
    draw, by_pair = random.Random(seed), {}
    for r in rows:
        by_pair.setdefault(r[1], []).append(r)

    def in_turn(groups, n):
        pools, out = [], []
        for key in sorted(groups):
            pool = list(groups[key])
            draw.shuffle(pool)
            pools.append(pool)
        while len(out) < n and any(pools):
            out += [p.pop() for p in pools if p][: n - len(out)]
        return out

    def grouped(found, key):
        out = {}
        for r in found:
            out.setdefault(key(r), []).append(r)
        return out

    if per_pair:
        out = []
        for lp in sorted(by_pair):
            n = min(per_pair, len(by_pair[lp]))
            out += in_turn(grouped(by_pair[lp], lambda r: bin_of(r[2])), n) if thresholds else draw.sample(by_pair[lp], n)
        return out
    every = [r for found in by_pair.values() for r in found]
    n = min(total, len(every))
    return in_turn(grouped(every, lambda r: f"{r[1]}::{bin_of(r[2])}"), n) if thresholds else draw.sample(every, n)


@pytest.mark.parametrize("per_pair,total,thresholds", [(7, 0, []), (9, 0, [30, 60]), (0, 25, []), (0, 25, [50]), (500, 0, [10])])
def test_benchmark_samples(spark, per_pair, total, thresholds):
    draw = random.Random(1)
    rows = [(i * 3, draw.choice(["en-ru", "de-en", "en-fr"]), float(draw.randrange(100))) for i in range(150)]
    table = spark.createDataFrame(rows, "dataset_idx long, lp string, score double").repartition(5)
    found = sampling.benchmark_sample(table, per_pair, total, thresholds, seed=7).collect()
    assert sorted(tuple(r) for r in found) == sorted(benchmark_by_force(rows, per_pair, total, thresholds, 7))


def test_stratified_samples(spark):
    """Drawn as with lists in memory, null values included."""
    source = random.Random(4)
    rows = [(source.choice("ab"), source.choice(["x", "y", None]), i) for i in range(90)]
    table = keyed(spark.createDataFrame(rows, "s string, kind string, id long"), ["id"], "s")
    pools, totals = {}, Counter(str(k) for _, k, _ in rows)
    for s, k, i in rows:
        pools.setdefault((s, str(k)), []).append(i)
    draw, expected = random.Random(42), []
    for s, k in sorted(pools):
        mine = pools[s, k]
        expected += [(s, k, mine[i], totals[k]) for i in draw.sample(range(len(mine)), min(5, len(mine)))]
    found = [(r.split, str(r.kind), r.id, r.group_count) for r in sampling.stratified(table, "kind", 5).collect()]
    assert sorted(found) == sorted(expected)


def test_samples_of_everything(spark):
    rows = keyed(spark.createDataFrame([(i, "ab"[i % 2]) for i in range(20)], "id long, s string"), ["id"], "s")
    assert sampling.per_split(rows, 0).count() == 20 and sampling.per_split(rows, 0, splits=["a"]).count() == 10


@pytest.mark.parametrize("blocks", [1, 3, 40])
def test_row_numbers(spark, blocks):
    draw = random.Random(2)
    rows = [(draw.randrange(50) if draw.random() > 0.1 else None, i, draw.choice("xyz")) for i in range(300)]
    table = spark.createDataFrame(rows, "a long, b long, s string").repartition(6)
    expected = {}
    for s in "xyz":
        mine = sorted((r for r in rows if r[2] == s), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        expected |= {r[1]: (s, i) for i, r in enumerate(mine)}
    assert {r.b: (r.split, r.row_idx) for r in keyed(table, ["a", "b"], "s", blocks).collect()} == expected
    assert keyed(table.limit(0), ["a", "b"], "s", blocks).count() == 0


def test_evaluation_checks(spark, tmp_path):
    pair = evaluation.FieldPair("translation", "text", "translation", "text_fr")
    with pytest.raises(ValueError, match="translation"):
        evaluation.Evaluation({"x": evaluation.Input("source")}, (), "x")
    with pytest.raises(ValueError, match="unknown inputs"):
        evaluation.Evaluation({"translation": evaluation.Input("source")}, (evaluation.FieldPair("a", "b", "translation", "c"),), "translation")
    spec = evaluation.Evaluation({"translation": evaluation.Input("translated", run_name="r2")}, (pair,), "translation", target_lang="French", translated_root="root", translated_name="name", dataset_id="d")
    assert evaluation.input_path(spec, spec.inputs["translation"]) == "root/fr/name/r2"
    assert evaluation.input_path(spec, evaluation.Input("path", "p")) == "p" and evaluation.input_path(spec, evaluation.Input("source")) is None
    for bad in (evaluation.Input("raw"), evaluation.Input("what")):
        with pytest.raises(ValueError):
            evaluation.input_path(spec, bad)
    with pytest.raises(FileNotFoundError):
        evaluation.load_inputs(spark, spec)
    rows = spark.createDataFrame([("s", 0, "a")], "split string, row_idx long, text string")
    assert evaluation.preflight(spec, {"translation": rows}) == ["translation: no column 'text_fr'"]
    good = rows.withColumn("text_fr", F.col("text"))
    assert evaluation.preflight(spec, {"translation": good}) == []
    wrong = evaluation.preflight(spec, {"translation": good}, {"translation": {"dataset": "e", "lang": "de", "run": "r1"}})
    assert len(wrong) == 3 and evaluation.preflight(spec, {"translation": good}, {"translation": {"dataset": "d", "lang": "fr", "run": "r2"}}) == []
    records = evaluation.evaluation_records(evaluation.evaluation_tasks(good.select("split", "row_idx", F.lit("").alias("group_value"), F.lit(1).alias("group_count")), {"translation": good}, spec), spec, "length", "{source_text}|{translation}|{target_lang}").collect()
    assert [(r.sample_id, r.source_text, r.status, r.score) for r in records] == [("s:0:text_fr", "a", "ok", 10.0)]


def test_audits(spark, tmp_path):
    value = audit.normal_value
    assert value("{'a': (1, None)}") == {"a": [1, ""]} and value('["x", {"k": NaN}]') == ["x", {"k": ""}] and value("[no") == "[no" and value(None) == "" and value(3) == 3
    pairs, errors = audit.nested_pairs(value('{"t": [{"text": "a", "id": "x"}, {"text": "b"}], "u": "c", "n": 1}'), value("{'t': [{'text_fr': 'A', 'text': 'a'}], 'n': 2}"), "fr")
    assert pairs == [("t[0].text_fr", "a", "A")] and errors == ["missing translated text at u", "length mismatch: 2 -> 1"]
    assert audit.nested_pairs([1], "x", "fr") == ([], ["type mismatch: list -> str"])
    detect = audit.detected_strategy
    assert detect([None, '[{"content": "a"}]'], [None, '[{"content_fr": "b", "content": "a"}]'], "fr") == ("serialized_dialog_turns_content", {"content_field": "content", "target_content_field": "content_fr"})
    assert detect(["[{'message': 'a'}]"], ["[{'message': 'b'}]"], "fr") == ("dialog_turns_content", {"content_field": "message"}) and detect(["a"], ["b"], "fr") == ("auto", {})

    rows = [("s", 0, "please open the door for me", "please open the door for me", ["a", "b"], ["x"]), ("s", 1, "ok", "", ["a"], ["x"])]
    table = spark.createDataFrame(rows, "split string, row_idx long, t string, t_fr string, l array<string>, l_fr array<string>")
    checked, issues = audit.audit_task(table, table, [("t", "t_fr"), ("l", "l_fr")], "fr")
    assert checked.count() == 4
    assert sorted((r.row_idx, r.code) for r in issues.collect()) == [(0, "list_length_mismatch"), (0, "unchanged_translation"), (1, "empty_translation")]

    plan = spark.createDataFrame([(i, *x) for i, x in enumerate([("d", "fr", "self_suffix", "r", "c", "s1"), ("d", "fr", "self_suffix", "r", "c", "s2"), ("d", "fr", "missing", "r", "c", "s3"), ("d", "fr", "source_compare", "r", "c", "s4")])], "plan_ord int, dataset string, lang string, mode string, target_repo string, target_config string, target_split string")
    done = spark.createDataFrame([("d", "fr", "r", "c", "s1", "ok"), ("d", "fr", "r", "c", "s2", "failed")], "dataset string, lang string, target_repo string, target_config string, target_split string, status string")

    def run(task):
        if task["target_split"] == "s4":
            raise ValueError("no parquet files")
        return {"errors": 0}

    assert [(r["target_split"], r["status"]) for r in audit.run_audit(plan, done, run)] == [("s2", "ok"), ("s4", "missing_split")]
    assert [r.target_split for r in audit.remaining(plan, done, 1).collect()] == ["s2"]
    audit.write_summary(spark.createDataFrame([("d", "fr", 3, ["é"])], "dataset string, lang string, rows long, notes array<string>"), str(tmp_path))
    assert (tmp_path / "quality_summary.csv").read_text().splitlines() == ["dataset,lang,rows,notes", 'd,fr,3,"[""é""]"']


def test_records_of_issues(spark):
    issues = [("warning", "c", "s", i, f"t[{i}].x", "a  b", "z", "m", 1 + i % 2) for i in range(4)] + [("error", "c", "t", 0, "u", "a b", "z", "m", None)]
    table = spark.createDataFrame(issues, "severity string, code string, split string, row_idx long, field string, source string, translation string, message string, duplicate_count int")
    found = {r.severity: r for r in metrics.issue_records(table).collect()}
    assert (found["warning"].occurrences, found["warning"].row_idx, found["warning"].fields, found["error"].splits) == (6, 0, ["t[].x"], ["t"])
    places = metrics.issue_locations(table)
    assert {(r.exact_field, r.position) for r in places.where("split = 's'").collect()} == {(f"t[{i}].x", f"item {i + 1}") for i in range(4)}
    records = metrics.issue_records(table)
    assert metrics.filtered_records(records, field="u").count() == 1 and metrics.filtered_records(records, search="A B").count() == 2 and metrics.filtered_records(records, split="s", code="d").count() == 0
    assert [r.severity for r in metrics.page(records, 0, 1).collect()] == ["error"]


def test_diagnostics(spark):
    facts = checks.with_facts(spark.createDataFrame([("Please open it", "Please open it")], "source string, translation string"))
    (r,) = checks.diagnostics(facts).collect()
    assert (r.diagnostics.source_letters, r.diagnostics.length_ratio, r.diagnostics.same_text, r.diagnostics.english_signal) == (12, 1.0, True, True) and len(r.diagnostics) == 11


def test_statistics_of_few_rows(spark):
    rows = [("m", "en-fr", "ok", 10.0, 10.0, "bin_0", "bin_0"), ("m", "en-de", "error", None, 1.0, None, "bin_0"), ("n", "en-de", "error", None, 1.0, None, "bin_0")]
    table = spark.createDataFrame(rows, "model string, lp string, status string, llm_score double, human_score_raw double, llm_bin string, human_bin string")
    table = table.withColumns({c: F.lit(None).cast("long") for c in ("usage_prompt_tokens", "usage_completion_tokens", "usage_total_tokens", "attempts", "rate_limit_waits")}).withColumn("usage_cost", F.lit(None).cast("double"))
    found = {(r.model, r.lp): (r.rows, r.ok_rows, r.n, r.pearson, r.spearman, r.cohen_kappa) for r in stats.benchmark_summary(table, ["bin_0", "bin_1"]).collect()}
    assert found == {("m", None): (2, 1, 1, None, None, None), ("m", "en-fr"): (2, 1, 1, None, None, None), ("n", None): (1, 0, None, None, None, None)}


def test_configuration(tmp_path):
    (tmp_path / "quality").mkdir()
    (tmp_path / "datasets").mkdir()
    (tmp_path / "uploads").mkdir()
    (tmp_path / "datasets" / "d.json").write_text('{"rules": [{"source": "a", "target": "a_fr", "strategy": "text"}, {"source": "j", "target": "j_fr", "strategy": "serialized_dialog_turns_content"}]}')
    (tmp_path / "datasets" / "r.json").write_text('{"reformat": {"text": "t", "history": "h", "roles": ["u", "s"]}}')
    (tmp_path / "uploads" / "u.json").write_text('{"export": {"layout": "multi_config", "configs": [{"config_name": "c", "transforms": [{"name": "replace_columns", "columns": {"a": "a_fr"}}, {"name": "serialized_dialog_content", "column": "j", "translated_column": "j_fr"}]}]}}')
    rules = lambda **k: [(r.source, r.target, r.strategy) for r in config.quality_rules(config.quality_from({"rules_from": k}), str(tmp_path))]
    assert rules(dataset="d") == [("a", "a_fr", "text"), ("j", "j_fr", "serialized_dialog_turns_content")]
    assert rules(dataset="d", upload="u", upload_config="c") == [("a", "a", "text"), ("j", "j", "serialized_dialog_turns_content")]
    assert rules(dataset="r") == [("t", "t", "text"), ("h", "h", "dialog_turns_content")]
    for k in ({"dataset": "d", "upload": "u"}, {"dataset": "d", "upload": "u", "upload_config": "x"}, {"dataset": "d", "workflow": "reformat"}):
        with pytest.raises(ValueError):
            rules(**k)
    with pytest.raises(FileNotFoundError):
        rules(dataset="none")
    for bad in ({}, {"rules": [{"source": "a"}], "rules_from": {"dataset": "d"}}, {"other": 1}):
        with pytest.raises(ValueError):
            config.quality_from(bad)
    assert config.overridden({"a": {"b": 1}}, ["a.b=2", "a.c.d=x", "e=[1]"]) == {"a": {"b": 2, "c": {"d": "x"}}, "e": [1]}
    with pytest.raises(ValueError):
        config.only(config.RunPolicy, {"what": 1})
    with pytest.raises(ValueError):
        config.BenchmarkConfig(("m",), thresholds=(2, 1))
    pytest.importorskip("yaml")
    (tmp_path / "q.yaml").write_text("rules:\n- source: a\n  target: b\n")
    assert config.quality_from(config.load(str(tmp_path / "q.yaml"))).rules[0].target == "b"


def test_replies(spark):
    replies = ['{"score": 85, "comment": "fine"}', '```yaml\n{"score": 120.5}\n```', 'Well: {"a": {"b": "}"}, "score": 40, "comment": "c {x}"} done', "my score: 72.5 ok", "no idea", None, "", '{bad {"score": 5}', '{"score": true}']
    table = spark.createDataFrame([(i, r) for i, r in enumerate(replies)], "i int, r string")
    found = [tuple(r.p) for r in table.select("i", S.parsed_score(F.col("r")).alias("p")).orderBy("i").collect()]
    assert found == [(85.0, "fine", "ok"), (100.0, "", "ok"), (40.0, "c {x}", "ok"), (72.5, "my score: 72.5 ok", "ok"), (None, "no idea", "parse_error"), (None, "", "parse_error"), (None, "", "parse_error"), (5.0, "", "ok"), (None, '{"score": true}', "parse_error")]


def test_fingerprints_of_equal_rows(spark):
    from dialoom.sources.tables import fingerprints

    of = lambda xs: fingerprints(spark.createDataFrame([("s", x) for x in xs], "split string, x string")).first().fingerprint
    assert of("AAC") != of("BBC") and of("ABC") == of("CBA")


def test_latest_of_equal_orders(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k long, o long, v string")
    assert sorted((r.k, r.v) for r in incremental.latest(rows, ["k"], ["o"]).collect()) == [(1, "b"), (2, "c")]


def test_sparse_draws_are_those_of_whole_shuffles():
    def by_lists(sizes, total, draw):
        pools, out = [], []
        for pool in sorted(sizes):
            places = list(range(sizes[pool]))
            draw.shuffle(places)
            pools.append((pool, places))
        while len(out) < total and any(places for _, places in pools):
            for pool, places in pools:
                if places and len(out) < total:
                    out.append((pool, places.pop()))
        return out

    choose = random.Random(1)
    for _ in range(300):
        seed, rounds = choose.random(), [({p: choose.choice([0, 1, 2, 3, 9, 40]) for p in "abcd"[: choose.randint(1, 4)]}, choose.randint(0, 60)) for _ in range(2)]
        one, other = random.Random(seed), random.Random(seed)
        for sizes, total in rounds:  # what is drawn later is the same too
            assert sampling.drawn_in_turn(sizes, total, one) == by_lists(sizes, total, other)


def test_draws_from_large_pools_take_little_memory():
    import tracemalloc

    tracemalloc.start()
    found = sampling.drawn_in_turn({"b": 3, "c": 10**8}, 100, random.Random(4))
    assert tracemalloc.get_traced_memory()[1] < 1 << 20
    tracemalloc.stop()
    assert len(found) == len(set(found)) == 100 and sum(p == "b" for p, _ in found) == 3


@pytest.mark.parametrize("keys", [(), ("g",)])
def test_ranks_by_ranges(spark, keys):
    draw = random.Random(6)
    rows = [(draw.choice("xy"), draw.choice([draw.random(), 0.5, float(draw.randint(0, 9))])) for _ in range(800)]
    expected = {}
    for g, v in rows:
        mine = [w for h, w in rows if not keys or h == g]
        expected[g, v] = sum(w < v for w in mine) + (sum(w == v for w in mine) + 1) / 2
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = stats.with_average_ranks(spark.createDataFrame(rows, "g string, v double").repartition(7), ["v"], keys).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(found) == 800 and all(r.v_rank == expected[r.g, r.v] for r in found)


def test_ranges_are_numbered_without_holding_rows_against_each(spark, tmp_path):
    from dialoom.operators.ranges import RangeLog

    log = RangeLog(spark, str(tmp_path / "r"), 10)
    rows = spark.range(1035).selectExpr("if(id < 1000, 'a', 'b') AS split", "if(id < 1000, id, id - 1000) AS row_idx")
    log.write(rows, [("a", 20, 30), ("a", 30, 37)], lambda df: df, 1)
    log.write(rows, list(log.pending({"a": 1000, "b": 35})), lambda df: df, 1)
    seen = log.records().groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in seen} == {"a": 1000, "b": 35}
    every = spark.read.option("basePath", log.path).parquet(log.path).selectExpr("split", "row_idx", "split(range, '~') AS p")
    assert every.where("p[0] <> split OR row_idx < cast(p[1] AS long) OR row_idx >= cast(p[2] AS long)").count() == 0
    assert not list(log.pending({"a": 1000, "b": 35}))
