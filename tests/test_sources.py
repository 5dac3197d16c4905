import json
import random

import pytest
from pyspark.sql import functions as F

from dialoom.operators import audit, report, translate
from dialoom.operators.incremental import latest
from dialoom.sources import objects, tables


def test_the_later_line_of_a_key(spark, tmp_path):
    at = tmp_path / "r.jsonl"
    at.write_text("".join(json.dumps({"k": i % 7, "v": i}) + "\n" for i in range(5000)) + "\n")
    rows = tables.read_lines(spark.newSession(), str(at), "k long, v long")
    assert rows.columns == ["k", "v", "line"]
    assert sorted((r.k, r.v) for r in latest(rows, ["k"], ["line"]).collect()) == sorted((k, max(i for i in range(5000) if i % 7 == k)) for k in range(7))
    assert tables.read_lines(spark, str(tmp_path / "none"), "k long").count() == 0


def test_pages_and_remotes(spark, tmp_path):
    tables.register_pages("letters", lambda offset, n: [{"text": f"t{i}", "more": 1} for i in range(offset, offset + n)], lambda: 257)
    rows = tables.read_pages(spark, "letters", "text string, absent int", "test")
    assert sorted((r.row_idx, r.text, r.absent, r.split) for r in rows.collect()) == [(i, f"t{i}", None, "test") for i in range(257)]
    assert tables.read_pages(spark, "letters", "text string", max_rows=30).count() == 30
    tables.register_remote("hub/x", lambda s: s.createDataFrame([("train", i) for i in range(3)], "split string, row_idx long"))
    spark.range(2).withColumnRenamed("id", "row_idx").write.parquet(str(tmp_path / "local"))
    read = lambda kind, **k: tables.read_source(spark, kind, **k).count()
    assert read("remote", remote="hub/x") == 3 and read("auto", remote="hub/x", path=str(tmp_path / "local")) == 3 and read("auto", remote="hub/x", path=str(tmp_path / "local"), prefer_local=True) == 2
    assert read("disk", path=str(tmp_path / "local"), max_rows=1) == 1
    for kind, k in (("disk", {"path": str(tmp_path / "none")}), ("disk", {}), ("remote", {"remote": str(tmp_path / "no")})):
        with pytest.raises(FileNotFoundError):
            read(kind, **k)


def test_columns_are_kept_once(spark, tmp_path):
    spark.range(5).withColumns({"a": F.lit("x"), "b": F.lit(1)}).write.parquet(str(tmp_path / "p"))
    of = lambda: tables.cached_columns(spark, [str(tmp_path / "p")], ["b", "id", "b"], str(tmp_path / "cache"))
    assert of().columns == ["b", "id"] and of().count() == 5
    assert len([x for x in (tmp_path / "cache").iterdir() if x.is_dir()]) == 1
    with pytest.raises(Exception, match="absent|UNRESOLVED"):
        tables.cached_columns(spark, [str(tmp_path / "p")], ["absent"], str(tmp_path / "cache"), retries=1)


def test_splits_side_files_and_heads(spark, tmp_path):
    for name in ("a", "b"):
        spark.range(2).withColumn("x", F.lit(name)).write.parquet(str(tmp_path / name))
    rows = tables.read_splits(spark, {"train": [str(tmp_path / "a")], "test": [str(tmp_path / "a"), str(tmp_path / "b")]}, ["x", "x"])
    assert rows.columns == ["x", "split"] and {r.split: r["count"] for r in rows.groupBy("split").count().collect()} == {"train": 2, "test": 4}
    tables.write_records(rows, str(tmp_path / "r"))
    tables.write_records(rows, str(tmp_path / "r"), append=True)
    assert tables.read_records(spark, str(tmp_path / "r"), "x string, split string").count() == 12
    tables.write_manifest(tables.manifest("k", "d", "r", "fr", {"train": "1"}), str(tmp_path / "m"))
    assert tables.read_manifest(str(tmp_path / "m"))["fingerprints"] == {"train": "1"}
    (tmp_path / "m" / "manifest.json").write_text("[]")
    with pytest.raises(ValueError):
        tables.read_manifest(str(tmp_path / "m"))
    with pytest.raises(ValueError, match="no split"):
        tables.with_passthrough(rows, [(rows, "absent", "y")])


def test_limits_and_guards(spark):
    call = translate.within_limit("deepl", lambda text, *_: text)
    assert call("é" * 60_000, "en", "fr") and translate.within_limit("google", lambda t, *_: t)("x" * 5000, "", "")
    for provider, text in (("deepl", "é" * 60_001), ("google", "x" * 5001), ("yandex", "x" * 10_001)):
        with pytest.raises(ValueError, match=provider):
            translate.within_limit(provider, lambda t, *_: t)(text, "en", "fr")
    rows = spark.createDataFrame([("12",), ("ab",), ("a1",)], "t string")
    keep = lambda guards: [r.t for r in rows.where(translate.passes_guards(F.col("t"), guards)).collect()]
    assert keep(None) == ["12", "ab", "a1"] and keep([{"kind": "no_letters"}, "what"]) == ["ab", "a1"] and keep([{"kind": "fullmatch_regex", "pattern": "[a-z]+"}]) == ["12", "a1"]
    for bad in ({"kind": "no_letters"}, [{"kind": "x"}]):
        with pytest.raises(ValueError):
            translate.passes_guards(F.col("t"), bad)


def test_summaries_of_audits(spark):
    issues = [("d", "fr", s, i, "warning", "c%d" % (i % 3), "f", "s", "t") for s in ("a", "b") for i in range(15)] + [("d", "fr", "a", 0, "error", "e", "f", "s", "t")]
    table = spark.createDataFrame(issues, "dataset string, lang string, target_split string, row_idx long, severity string, code string, field string, source string, translation string")
    checked = spark.createDataFrame([("d", "fr", s, i // 2) for s in ("a", "b", "z") for i in range(40)], "dataset string, lang string, target_split string, row_idx long")
    keys = ["dataset", "lang", "target_split"]
    results = audit.task_results(table, keys, checked)
    found = {r.target_split: r for r in results.collect()}
    assert (found["a"].errors, found["a"].warnings, found["a"].issue_rows, found["a"].checked_rows, found["a"].checked_pairs, len(found["a"].examples)) == (1, 15, 15, 20, 40, 10)
    assert (found["z"].errors, found["z"].checked_pairs, found["z"].examples) == (0, 40, None) and [e.row_idx for e in found["a"].examples[:3]] == [0, 0, 1]
    plan = spark.createDataFrame([("d", "fr", s, "self_suffix", "") for s in ("a", "b", "z")], "dataset string, lang string, target_split string, mode string, note string")
    rows = checked.groupBy(*keys).agg(F.count_distinct("row_idx").alias("rows"))
    (r,) = audit.audit_summary(plan, results, rows).collect()
    assert (r.rows, r.errors, r.warnings, r.pct, r.status, r.top_codes) == (60, 1, 30, 50.0, "errors", "c0:10,c1:10,c2:10,e:1") and len(r.examples) == 3


def test_report_page():
    found = {"verdict": "pass", "checked_pairs": 1, "errors": 0, "warnings": 1, "recommendation": "review", "guide": [{"rule": "<R>", "n": 1, "label": "l", "meaning": "m", "action": "a"}], "splits": [{"split": "s"}], "issues": [{"code": "c", "split": "s", "source": "</script>"}], "truncated": True}
    page = report.html_page(found, "T")
    assert "&lt;R&gt;" in page and "<\\/script>" in page and page.count("</script>") == 2 and "Not all issues" in page and "join('\\n')" not in page and "'\\n'" in page


@pytest.mark.parametrize("block", ["64b", "1000b", "128m"])
def test_objects_are_read_in_parts(spark, tmp_path, block):
    """Strings with every mark in them, escapes, nested values, white space: as one task or as many."""
    draw = random.Random(3)
    strings = ["", "a", "}", "{", "},{", '"', "\\\\", '\\\\"', "\n", "é漢", "[", "]", ",", ":", '"log"', "}}\\", "x" * 150]

    def value(level):
        kind = draw.randrange(5 if level else 3)
        if kind == 3:
            return [value(level - 1) for _ in range(draw.randint(0, 3))]
        if kind == 4:
            return {draw.choice(strings) + str(i): value(level - 1) for i in range(draw.randint(0, 3))}
        return draw.choice([None, True, -1.5, 7]) if kind == 0 else "".join(draw.choice(strings) for _ in range(draw.randint(0, 4)))

    for k in range(4):
        expected = {f"{draw.choice(strings)} {i}": value(3) for i in range(40 * k)}
        at = tmp_path / f"{k}.json"
        at.write_text("\n " * (k % 2) + json.dumps(expected, ensure_ascii=bool(k % 2), indent=draw.choice([None, 1])) + "\n" * k, encoding="utf-8")
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        try:
            rows = objects.read_object(spark, str(at))
            found = rows.collect()
            tasks = objects.pieces(spark, str(at)).rdd.getNumPartitions()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert {r.key: json.loads(r.value) for r in found} == expected and len(found) == len(expected)
        assert [r.key for r in sorted(found, key=lambda r: r.place)] == list(expected)
        assert block != "64b" or k < 2 or tasks > 20
    (tmp_path / "list.json").write_text('[1, {"a": 2}]')
    assert objects.read_object(spark, str(tmp_path / "list.json")).count() == 0


def test_pages_are_asked_for_again(spark, tmp_path):
    """A server that fails now and then, as partitions of a few pages each; one that fails for good, or lies, ends the job."""

    def fetch(offset, n):
        mark = tmp_path / str(offset)
        if offset % 40 == 0 and not mark.exists():
            mark.touch()
            raise OSError("busy")
        return [{"text": f"t{i}", "n": i} for i in range(offset, offset + n)]

    tables.register_pages("shaky", fetch, lambda: 205)
    rows = tables.read_pages(spark, "shaky", "n long, text string", size=10, pages=3, sleep=0)
    assert rows.rdd.getNumPartitions() == 7
    assert sorted((r.row_idx, r.n, r.text) for r in rows.collect()) == [(i, i, f"t{i}") for i in range(205)]
    assert sorted(int(x.name) for x in tmp_path.iterdir()) == [0, 40, 80, 120, 160, 200]
    tables.register_pages("down", lambda offset, n: 1 / 0, lambda: 5)
    tables.register_pages("short", lambda offset, n: [{"n": 1}], lambda: 5)
    for name, said in (("down", "2 attempts"), ("short", "1 came")):
        with pytest.raises(Exception, match=said):
            tables.read_pages(spark, name, "n long", retries=1, sleep=0).collect()
    tables.register_pages("none", lambda offset, n: [], lambda: 0)
    assert tables.read_pages(spark, "none", "n long").collect() == []
