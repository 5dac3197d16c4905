"""Calls of services: once for each request, several at once, one limit for all tasks, and runs that are taken up again."""

import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from dialoom import cli, config
from dialoom.operators import answers, calls, judge, ranges, strategies, translate
from dialoom.operators.pairs import Rule
from dialoom.operators.runs import RetryPolicy
from dialoom.sources import files


def counting(name, path, change=str.upper, again=None):
    """A translator that leaves a line for each call."""

    def call(text, source, target):
        with open(path, "a") as f:
            f.write(text.replace("\n", " ") + "\n")
        return change(text)

    translate.register_translator(name, call, again)
    return lambda: path.read_text().splitlines() if path.exists() else []


def lists_of(spark, n=50):
    rows = [("s", i, [f"item {i} first", f"item {i} second"], f"please send the report number {i} to me", [(f"turn {i}",)]) for i in range(n)]
    return spark.createDataFrame(rows, "split string, row_idx long, l array<string>, t string, d array<struct<content:string>>")


STRATEGIES = [("l", "text_list"), ("d", "dialog_turns_content"), ("j", "serialized_text_list"), ("n", "deep_map_texts"), ("t", "text"), ("t", "structured_entity"), ("q", "weblinx_query")]


def test_every_strategy_calls_once(spark, tmp_path):
    sent = counting("counted", tmp_path / "calls")
    source = lists_of(spark, 12).withColumns({"j": F.to_json("l"), "n": F.struct(F.col("t").alias("a")), "q": F.concat(F.lit("User: "), F.col("t"))})
    done = strategies.translated(source, [Rule(c, f"{c}_{strategy}", strategy) for c, strategy in STRATEGIES], "counted")
    for _ in range(2):
        assert done.where("status = 'ok'").count() == 12
    # lists are one request each, those in JSON the same ones; so are a text, an entity without parts and what a user says
    assert len(sent()) == len(set(sent())) == 4 * 12
    r = done.where("row_idx = 3").first()
    assert (r.t_text, r.q_weblinx_query, r.n_deep_map_texts.a) == (r.t.upper(), f"User: {r.t.upper()}", r.t.upper()) and r.l_text_list == [x.upper() for x in r.l] == json.loads(r.j_serialized_text_list)


def test_rules_retries_and_repeats_call_once(spark, tmp_path):
    source = lists_of(spark)
    sent = counting("counted", tmp_path / "three")
    done = strategies.translated(source, [Rule("l", "l_fr", "text_list"), Rule("t", "t_fr", "text"), Rule("d", "d_fr", "dialog_turns_content")], "counted")
    assert done.where("status = 'ok'").count() == 50 and len(sent()) == 150
    # a text that comes back as it was is sent once more, past the service's memory
    second = counting("again", tmp_path / "second", lambda t: f"envoyez {t}")
    again = translate.TRANSLATORS["again"]
    first = counting("stuck", tmp_path / "first", str, again)
    done = strategies.translated(source.unionByName(source.withColumn("row_idx", F.col("row_idx") + 50)), [Rule("t", "t_fr", "text", {"retry_unchanged": True})], "stuck")
    assert done.where("status = 'ok' and t_fr = 'envoyez ' || t").count() == 100 and len(first()) == len(second()) == 50


def test_answers_of_a_killed_job_stay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(answers, "REQUESTS", 5)
    texts = spark.createDataFrame([(f"text {i}",) for i in range(60)], "text string")
    path, marker = tmp_path / "calls", tmp_path / "fixed"

    def call(text, source, target):
        with open(path, "a") as f:
            f.write(text + "\n")
        if text == "text 7" and not marker.exists():
            import os

            time.sleep(6)
            os._exit(1)
        return text.upper()

    translate.register_translator("dies", call)
    with pytest.raises(Exception):  # noqa: B017  whatever Spark makes of a lost worker
        answers.AnswerLog(spark, str(tmp_path / "log")).ask(texts, "dies")
    marker.touch()
    first = path.read_text().splitlines()
    log = answers.AnswerLog(spark, str(tmp_path / "log"))
    there = log.rows().count()
    assert there >= 20
    found = log.ask(texts, "dies")
    assert {r.text: r.translation for r in found.collect()} == {f"text {i}": f"TEXT {i}" for i in range(60)}
    assert len(path.read_text().splitlines()) - len(first) == 60 - there
    # failures are remembered in a run, and asked again in the next one
    counted = counting("bad", tmp_path / "bad", lambda t: 1 / 0)
    one = texts.limit(1)
    for _ in range(2):
        assert log.ask(one, "bad", retries=0).first().status == "error"
    assert len(counted()) == 1
    assert answers.AnswerLog(spark, str(tmp_path / "log")).ask(one, "bad", retries=0).first().status == "error" and len(counted()) == 2
    log.compact()
    assert len(log.parts()) == 1 and log.rows().count() == 60


def test_calls_at_once_and_in_order():
    limit = calls.Limit(0, 0)
    assert [r.value for r in calls.replies(list("abc"), str.upper, RetryPolicy(0), limit)] == ["A", "B", "C"]


def test_slow_calls_take_as_long_as_one(spark):
    judge.JUDGES["slow"] = lambda prompt: time.sleep(1.0) or '{"score": 1}'
    rows = spark.range(48).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("prompt"), "id")
    judge.judged(rows.limit(4), "slow", concurrency=48).count()
    began = time.time()
    found = judge.judged(rows, "slow", concurrency=48).collect()
    assert time.time() - began < 10 and sorted(r.id for r in found) == list(range(48)) and all(r.prompt == f"p{r.id}" for r in found)


def test_one_limit_for_all_tasks(spark, tmp_path, monkeypatch):
    """Never more calls open than may be, and never more begun in a window, from eight tasks."""
    monkeypatch.setattr(calls, "WINDOW", 4.0)
    path = tmp_path / "times"

    def call(prompt):
        with open(path, "a") as f:
            f.write(f"{time.time()} 1\n")
        time.sleep(0.05)
        with open(path, "a") as f:
            f.write(f"{time.time()} -1\n")
        return '{"score": 1}'

    judge.JUDGES["timed"] = call
    rows = spark.range(0, 30, 1, 8).select(F.col("id").cast("string").alias("prompt"))
    found = judge.judged(rows, "timed", per_minute=13, concurrency=3).collect()
    events = sorted((float(t), int(x)) for t, x in (line.split() for line in path.read_text().splitlines()))
    starts, open_now, most = [t for t, x in events if x == 1], 0, 0
    for _, x in events:
        open_now += x
        most = max(most, open_now)
    assert len(starts) == 30 and most <= 3
    assert all(starts[i + 13] - starts[i] > 3.5 for i in range(17))
    assert sum(r.rate_limit_waits for r in found) >= 4 and sum(r.rate_limit_wait_seconds for r in found) > 1


def test_a_lost_call_gives_its_place_back(spark):
    limit = calls.shared_limit(spark, 0, 1)
    first, _ = limit.enter()
    waiting = []
    other = threading.Thread(target=lambda: waiting.append(limit.enter()))
    other.start()
    time.sleep(0.3)
    assert not waiting
    first.close()  # as the system does when a task is lost
    other.join(10)
    assert waiting
    waiting[0][0].close()
    with pytest.raises(ConnectionError):
        calls.Limit(0, 1, limit.host, limit.port, "0" * 32).enter()


def test_ranges(spark, tmp_path):
    rows = spark.createDataFrame([(s, i, f"{s}{i}") for s, n in (("a b/~", 25), ("c", 7)) for i in range(n) if (s, i) != ("c", 3)], "split string, row_idx long, x string")
    log, seen = ranges.RangeLog(spark, str(tmp_path / "r"), 4), []

    def process(bad):
        def run(part):
            seen.append(sorted((r.split, r.row_idx) for r in part.collect()))
            return part.withColumn("status", F.when(F.col("row_idx").isin(bad), "error").otherwise("ok"))

        return run

    assert log.records() is None and len(list(log.pending({"a b/~": 25, "c": 7}))) == 9
    log.write(rows, list(log.pending({"a b/~": 25, "c": 7}))[:2], process([2]), 1)
    log.run(rows, process([6]))
    log.run(rows, process([]))
    assert seen[0] == [("a b/~", i) for i in range(8)]
    assert seen[1] == [("a b/~", i) for i in range(8, 25)] + [("c", i) for i in range(7) if i != 3]
    assert seen[2] == [("a b/~", 2)] and seen[3] == [("c", 6)]
    assert sorted((r.split, r.row_idx, r.x, r.status) for r in log.records().collect()) == sorted((r.split, r.row_idx, r.x, "ok") for r in rows.collect())
    log.run(rows, process([]))
    assert len(seen) == 4


def test_translate_is_taken_up_again(spark, tmp_path, capsys):
    """A run that dies sends nothing of what is there again; ranges that are there are not even read."""
    rows = [("train", i, f"text {i}") for i in range(40)] + [("test", 0, "other")]
    spark.createDataFrame(rows, "split string, row_idx long, text string").write.parquet(str(tmp_path / "source"))
    fixed, path = tmp_path / "fixed", tmp_path / "calls"

    def call(text, source, target):
        with open(path, "a") as f:
            f.write(text + "\n")
        if text == "text 30" and not fixed.exists():
            import os

            os._exit(1)
        if text == "text 5" and len([x for x in path.read_text().splitlines() if x == text]) < 2:
            raise OSError("once")
        return text.upper()

    translate.register_translator("dies late", call)
    (tmp_path / "c.json").write_text(json.dumps({"rules": [{"source": "text", "target": "text_fr", "strategy": "text"}], "translator": "dies late", "policy": {"batch_size": 10, "retries": 0, "concurrency": 2}}))
    arguments = ["translate", "--config", str(tmp_path / "c.json"), "--source", str(tmp_path / "source"), "--out", str(tmp_path / "out")]
    step, ranges.AT_ONCE = ranges.AT_ONCE, 1
    try:
        with pytest.raises(Exception):  # noqa: B017
            cli.main(arguments)
    finally:
        ranges.AT_ONCE = step
    done = [f"text {i}" for i in range(30)] + ["other"]
    assert set(done) <= set(path.read_text().splitlines())
    fixed.touch()
    before = len(path.read_text().splitlines())
    assert cli.main(arguments) == 0
    later = path.read_text().splitlines()[before:]
    assert not set(later) & (set(done) - {"text 5"}) and later.count("text 5") == 1
    found = {(r.split, r.row_idx): r.text_fr for r in spark.read.parquet(str(tmp_path / "out" / "dataset")).collect()}
    assert found == {(s, i): t.upper() for s, i, t in rows}
    with pytest.raises(ValueError, match="other rules"):
        cli.main([*arguments, "--set", "languages=[\"en\",\"ru\"]"])


def test_judges_are_called_by_the_policy(spark, tmp_path):
    path = tmp_path / "calls"

    def fails(prompt, max_tokens=0):
        with open(path, "a") as f:
            f.write(f"{max_tokens}\n")
        raise OSError("down")

    judge.JUDGES["down"] = fails
    rows = [("train", i, f"text {i}", f"texte {i}") for i in range(3)]
    spark.createDataFrame(rows, "split string, row_idx long, text string, text_fr string").write.parquet(str(tmp_path / "t"))
    pair = {"source_dataset": "translation", "source_field": "text", "translation_dataset": "translation", "translation_field": "text_fr"}
    payload = {"inputs": {"translation": {"kind": "path", "path": str(tmp_path / "t")}}, "sample_dataset": "translation", "samples": 2, "field_pairs": [pair], "judge": "down", "policy": {"sleep": 0, "max_completion_tokens": 77}}
    (tmp_path / "e.json").write_text(json.dumps(payload))
    assert cli.main(["evaluate", "--config", str(tmp_path / "e.json"), "--out", str(tmp_path / "o")]) == 0
    assert path.read_text().split() == ["77"] * 8  # two tasks, each once and three times more
    assert config.JudgePolicy().calls()["per_minute"] == 60
    with pytest.raises(ValueError):
        config.JudgePolicy(retries=-1)


def test_small_files(spark, tmp_path):
    at = f"file:{tmp_path}/a/b.json"
    assert files.read_text(spark, at) is None and files.names(spark, f"file:{tmp_path}/none") == []
    files.write_text(spark, at, "é1")
    files.write_text(spark, at, "é2")
    assert files.read_text(spark, at) == "é2" and files.names(spark, f"file:{tmp_path}/a") == ["b.json"]
    with pytest.raises(FileExistsError):
        files.move(spark, at, at)
