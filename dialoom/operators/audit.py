"""Audit of many datasets by a plan: which tasks run, and what they add up to."""

from __future__ import annotations

import ast
import csv
import io
import json
import threading
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import files
from ..sources.tables import read_plan, read_split
from . import checks
from .pairs import KEYS, Rule, aligned, text_pairs

# Modes of a plan that are audited, and keys of nested values that hold no text.
AUDITABLE = ["self_suffix", "source_compare"]
SKIPPED_KEYS = frozenset("id idx name role turn_id span_start span_end doc_id".split())
PLAN_COLUMNS = ["dataset", "lang", "mode", "target_repo", "target_config", "target_split", "pairs", "source_repo", "source_config", "source_split", "note"]
TASK = ["dataset", "lang", "target_repo", "target_config", "target_split"]


def column_pairs(c: Column) -> Column:
    """`a->b; c->d` as array<struct<source, target>>."""
    parts = F.filter(F.transform(F.split(c, ";"), F.trim), lambda p: p.contains("->"))
    return F.transform(parts, lambda p: F.struct(F.trim(F.split(p, "->")[0]).alias("source"), F.trim(F.split(p, "->")[1]).alias("target")))


def is_title_field(c: Column) -> Column:
    return F.lower(c).rlike("title|topic|entity|name")


def excluded(plan: DataFrame, exclusions: list[str]) -> DataFrame:
    """The plan with tasks of `dataset:lang[,lang]` set to mode `excluded`."""
    hit = F.lit(False)
    for text in exclusions:
        dataset, _, langs = text.partition(":")
        if not langs:
            raise ValueError(f"expected dataset:lang, got {text!r}")
        hit = hit | ((F.col("dataset") == dataset) & F.col("lang").isin([x.strip() for x in langs.split(",")]))
    return plan.withColumns({"mode": F.when(hit, "excluded").otherwise(F.col("mode")), "note": F.when(hit, "excluded by request").otherwise(F.coalesce("note", F.lit("")))})


def auditable(plan: DataFrame) -> DataFrame:
    return plan.where(F.col("mode").isin(AUDITABLE))


def mode_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("mode").agg(F.count("*").alias("n"))


def task_results(issues: DataFrame, keys: list[str], checked: DataFrame | None = None, examples: int = 10, codes: int = 10) -> DataFrame:
    """By task: errors, warnings, rows with issues, commonest codes, and the first examples; with checked rows and pairs where these are given.

    Examples are cut off by rank before they are gathered.
    """
    by_code = issues.groupBy(*keys, "code").agg(F.count("*").alias("n"))
    common = by_code.groupBy(*keys).agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "code", "n"))), 1, codes).alias("codes"))
    rows = issues.groupBy(*keys, "row_idx").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    totals = rows.groupBy(*keys).agg(F.sum("errors").alias("errors"), F.sum("warnings").alias("warnings"), F.count("*").alias("issue_rows"))
    one = F.struct("row_idx", "code", "field", "source", "translation")
    first = issues.withColumn("k", F.row_number().over(Window.partitionBy(*keys).orderBy("row_idx", "code", "field", "source"))).where(F.col("k") <= examples)
    shown = first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", one.alias("x")))), lambda e: e["x"]).alias("examples"))
    out = totals.join(common, keys).join(shown, keys).withColumn("example", F.col("examples")[0])
    if checked is None:
        return out
    counts = checked.groupBy(*keys).agg(F.count_distinct("row_idx").alias("checked_rows"), F.count("*").alias("checked_pairs"))
    return counts.join(out, keys, "left").fillna(0, ["errors", "warnings", "issue_rows"])


def audit_summary(plan: DataFrame, results: DataFrame, rows: DataFrame) -> DataFrame:
    """By dataset and language: sums over its tasks, share of rows with issues, commonest codes and first examples of all, and the worst status of any."""
    keys = ["dataset", "lang"]
    tasks = plan.join(results, [*keys, "target_split"], "left").join(rows, [*keys, "target_split"], "left").fillna(0, ["errors", "warnings", "issue_rows", "rows"])
    status = F.when(F.sum("errors") > 0, "errors").when(F.sum("warnings") > 0, "warnings").when(F.count_if(F.col("mode").isin(AUDITABLE)) > 0, "ok").otherwise(F.min("mode"))
    out = tasks.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.sum("errors").alias("errors"), F.sum("warnings").alias("warnings"), F.sum("issue_rows").alias("issue_rows"),
        F.round(F.try_divide(100 * F.sum("issue_rows"), F.sum("rows")), 4).alias("pct"), status.alias("status"), F.array_join(F.slice(F.array_sort(F.collect_set(F.when(F.col("note") != "", F.col("note")))), 1, 5), "; ").alias("notes"),
    )
    if "codes" in results.columns:
        merged = tasks.select(*keys, F.explode("codes").alias("c")).groupBy(*keys, "c.code").agg(F.sum("c.n").alias("n"))
        top = merged.groupBy(*keys).agg(F.array_join(F.transform(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "code", "n"))), 1, 5), lambda c: F.concat(c["code"], F.lit(":"), c["n"].cast("string"))), ",").alias("top_codes"))
        out = out.join(top, keys, "left").fillna("", ["top_codes"])
    if "examples" in results.columns:
        few = tasks.groupBy(*keys).agg(F.slice(F.flatten(F.transform(F.array_sort(F.collect_list(F.when(F.col("examples").isNotNull(), F.struct("target_split", F.slice("examples", 1, 2).alias("x"))))), lambda t: t["x"])), 1, 3).alias("examples"))
        out = out.join(few, keys, "left")
    return out


def normal_value(value: object) -> object:
    """A value as texts, lists and mappings: null is empty, and a text that is written like a list or mapping is read as one."""
    if value is None or isinstance(value, float) and value != value:
        return ""
    if isinstance(value, str):
        body = value.strip()
        if body[:1] in ("[", "{"):
            for read in (json.loads, ast.literal_eval):
                try:
                    return normal_value(read(body))
                except (ValueError, SyntaxError, TypeError, RecursionError, MemoryError):
                    continue
        return value
    if isinstance(value, (list, tuple)):
        return [normal_value(x) for x in value]
    if isinstance(value, dict):
        return {str(k): normal_value(x) for k, x in value.items()}
    return value


def nested_pairs(source: object, target: object, lang: str, path: str = "") -> tuple[list[tuple[str, str, str]], list[str]]:
    """(path, source text, translated text) of two normal values side by side, and what does not fit.

    A key's translation is under the key with the language's suffix, or under the key itself; keys that hold no text are left out.
    """
    kind = lambda x: dict if isinstance(x, dict) else list if isinstance(x, list) else None
    if kind(source) is not kind(target):
        return [], [f"type mismatch: {type(source).__name__} -> {type(target).__name__}"]
    text = lambda x: str(x or "")
    pairs: list[tuple[str, str, str]] = []
    errors: list[str] = []
    if kind(source) is None:
        return [(path, text(source), text(target))], []
    if isinstance(source, list):
        if len(source) != len(target):
            errors.append(f"length mismatch: {len(source)} -> {len(target)}")
        steps = [(f"{path}[{i}]", a, b) for i, (a, b) in enumerate(zip(source, target, strict=False))]
    else:
        steps = []
        for key, a in source.items():
            if key in SKIPPED_KEYS:
                continue
            there = next((k for k in (f"{key}_{lang}", key) if k in target), None)
            at = lambda k: f"{path}.{k}" if path else k
            if there is None:
                if isinstance(a, str) and a.strip():
                    errors.append(f"missing translated text at {at(key)}")
                continue
            b = target[there]
            if kind(a) is None and kind(b) is None and not isinstance(a, str) and not isinstance(b, str):
                continue
            steps.append((at(there), a, b))
    for at, a, b in steps:
        found, wrong = nested_pairs(a, b, lang, at)
        pairs += found
        errors += wrong
    return pairs, errors


def read_pairs(rows: DataFrame, source: str, target: str, lang: str, field: str = "") -> DataFrame:
    """The pairs of two text columns whose values may be written as JSON or as literals: the rows of text_pairs.

    Values differ in shape from row to row, so they are read in Arrow batches; pairs of other columns are expressions.
    """
    name, types = field or target, {"split": pa.string(), "row_idx": pa.int64(), "rule_ord": pa.int32(), "pair_ord": pa.int32(), "field": pa.string(), "source": pa.string(), "translation": pa.string(), "error": pa.string()}

    def run(batches):
        for batch in batches:
            out = []
            for split, row, a, b in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                found, errors = nested_pairs(normal_value(a), normal_value(b), lang)
                out += [(split, row, 0, -1, name, None, None, e) for e in errors]
                out += [(split, row, 0, i, name + (p if p.startswith("[") or not p else f".{p}"), s, t, None) for i, (p, s, t) in enumerate(found)]
            columns = zip(*out, strict=True) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], names=list(types))

    schema = "split string, row_idx long, rule_ord int, pair_ord int, field string, source string, translation string, error string"
    return rows.select(*KEYS, F.col(source).cast("string"), F.col(target).cast("string")).mapInArrow(run, schema)


def detected_strategy(source: list[str | None], target: list[str | None], lang: str) -> tuple[str, dict]:
    """How to compare two columns, from a few of their values: turns written as JSON, lists of turns, or as they are."""
    for a, b in zip(source, target, strict=False):
        if isinstance(a, str) and isinstance(b, str) and a.lstrip().startswith("[") and b.lstrip().startswith("["):
            try:
                x, y = json.loads(a), json.loads(b)
            except ValueError:
                continue
            has = lambda turns, key: isinstance(turns, list) and any(isinstance(t, dict) and key in t for t in turns)
            if has(x, "content") and has(y, "content"):
                own = f"content_{lang}"
                return "serialized_dialog_turns_content", {"content_field": "content", "target_content_field": own if has(y, own) else "content"}
    for a, b in zip(source, target, strict=False):
        x, y = normal_value(a), normal_value(b)
        of = lambda v: next((k for k in ("content", "message") if isinstance(v, list) and any(isinstance(t, dict) and k in t for t in v)), None)
        if of(x) and of(x) == of(y):
            return "dialog_turns_content", {"content_field": of(x)}
    return "auto", {}


def audit_task(source: DataFrame, target: DataFrame, pairs: list[tuple[str, str]], lang: str) -> tuple[DataFrame, DataFrame]:
    """(checked pairs, issues) of one task: rows side by side, its columns pair by pair, with titles allowed where a name says so."""
    rows = aligned(source, target)
    checked, issues = [], []
    for k, (a, b) in enumerate(pairs):
        both = rows.select(*KEYS, F.col("src")[a].alias("s"), F.col("tgt")[b].alias("t"))
        texts = all(dict(both.dtypes)[c] == "string" for c in ("s", "t"))
        found = read_pairs(both, "s", "t", lang, b) if texts else text_pairs(rows, [Rule(a, b)])
        found = found.withColumn("rule_ord", F.lit(k))
        good = checks.check_pairs(found.where("error is null"), title_allowed=any(w in b.lower() for w in ("title", "topic", "entity", "name")))
        checked.append(good)
        keys = [*KEYS, "rule_ord", "pair_ord", "field"]
        broken = found.where("error is not null").select(*keys, F.lit("error").alias("severity"), F.when(F.contains("error", F.lit("length mismatch")), "list_length_mismatch").otherwise("field_type_mismatch").alias("code"))
        issues.append(checks.issues_of(good, keys).select(*keys, "severity", "code", "source", "translation").unionByName(broken, allowMissingColumns=True))
    out, all_issues = checked[0], issues[0]
    for more, rest in zip(checked[1:], issues[1:], strict=True):
        out, all_issues = out.unionByName(more), all_issues.unionByName(rest)
    return out, all_issues


def remaining(plan: DataFrame, done: DataFrame, limit: int = 0) -> DataFrame:
    """Tasks to audit that no record with status ok or missing_split is for; the first so many, in the plan's order (plan_ord)."""
    todo = auditable(plan).join(done.where(F.col("status").isin("ok", "missing_split")).select(*TASK).distinct(), TASK, "left_anti")
    return todo.orderBy("plan_ord").limit(limit) if limit > 0 else todo


def run_audit(plan: DataFrame, done: DataFrame, audit: Callable[[dict], dict], limit: int = 0, at_once: int = 1, record: Callable[[dict], None] = lambda row: None) -> list[dict]:
    """A record of every task that is left: what audit(task) gives with status ok, or why it failed. Plans are short lists.

    So many tasks run at once, each as jobs of a pool of its own, which share the cluster where its scheduler is fair (spark.scheduler.mode).
    record: called with each record as it is made, so that a run that ends goes on with the others.
    """
    spark, lock = plan.sparkSession, threading.Lock()
    tasks = [row.asDict() for row in remaining(plan, done, limit).orderBy("plan_ord").collect()]

    def one(row: dict) -> dict:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"audit-{row['plan_ord']}")
        try:
            out = {**row, **audit(row), "status": "ok", "error": ""}
        except Exception as e:  # a task's failure is its record
            out = {**row, "status": "missing_split" if "no parquet files" in str(e) else "failed", "error": f"{type(e).__name__}: {str(e)[:300]}"}
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
        with lock:
            record(out)
        return out

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        return list(pool.map(one, tasks))


RECORD = "dataset string, lang string, target_repo string, target_config string, target_split string, status string, error string, rows long, checked_rows long, checked_pairs long, errors long, warnings long, issue_rows long, codes array<struct<o:long,code:string,n:long>>, examples array<struct<row_idx:long,code:string,field:string,source:string,translation:string>>"


def audited(spark: SparkSession, root: str, task: dict) -> dict:
    """What a task of a plan comes to: its rows and pairs, issues by severity, rows that have some, the commonest codes and the first examples."""
    suffix = task["mode"] == "self_suffix"
    pairs = [(p["source"], p["target"]) for p in task["pair_list"]]
    target = read_split(spark, root, task["target_repo"], task["target_config"], task["target_split"], [b for _, b in pairs] + [a for a, _ in pairs if suffix])
    source = target if suffix else read_split(spark, root, task["source_repo"], task["source_config"], task["source_split"], [a for a, _ in pairs]).withColumn("split", F.lit(task["target_split"]))
    checked, issues = audit_task(source, target, pairs, task["lang"])
    checked = checked.withColumn("task", F.lit(0)).persist(StorageLevel.DISK_ONLY)
    issues = issues.withColumn("task", F.lit(0)).persist(StorageLevel.DISK_ONLY)
    try:
        found = task_results(issues, ["task"], checked).drop("task", "example").first()
        rows = target.count()
    finally:
        checked.unpersist()
        issues.unpersist()
    return {"rows": rows, **(found.asDict(recursive=True) if found else {"checked_rows": 0, "checked_pairs": 0, "errors": 0, "warnings": 0, "issue_rows": 0})}


def audit_plan(spark: SparkSession, plan_path: str, root: str, out: str, exclude: list[str] = (), limit: int = 0, reset: bool = False, at_once: int = 4) -> list[dict]:
    """Audit what is left of a plan, keep a record of every task as it ends, and write the summary of all; gives the new records."""
    plan = excluded(read_plan(spark, plan_path), list(exclude)).withColumn("plan_ord", F.monotonically_increasing_id()).withColumn("pair_list", column_pairs(F.coalesce("pairs", F.lit(""))))
    folder = f"{out}/tasks"
    if reset:
        files.delete(spark, folder)
    before = lambda: spark.read.schema(RECORD).json(folder) if files.names(spark, folder) else spark.createDataFrame([], RECORD)

    def record(row: dict) -> None:
        kept = {k: v for k, v in row.items() if k not in ("pair_list", "plan_ord")}
        files.write_text(spark, f"{folder}/{uuid.uuid4().hex}.json", json.dumps({**kept, "made_at": time.time_ns()}, ensure_ascii=False) + "\n")

    new = run_audit(plan, before(), lambda task: audited(spark, root, task), limit, at_once, record)
    if not files.names(spark, folder):
        results = before()
    else:  # the last record of each task
        kind = before().schema.add("made_at", "long")
        results = spark.read.schema(kind).json(folder).groupBy(*TASK).agg(F.max_by(F.struct(*(c for c in before().columns if c not in TASK)), "made_at").alias("r")).select(*TASK, "r.*")
    # a dataset's repositories and configurations are tasks of their own
    keys = ["dataset", "lang", "target_split"]
    label = F.concat_ws("/", "target_repo", "target_config", "target_split")
    named = lambda df: df.withColumn("target_split", label)
    write_summary(audit_summary(named(plan), named(results).select(*keys, "errors", "warnings", "issue_rows", "codes", "examples"), named(results).select(*keys, "rows")), out)
    return new


def write_summary(summary: DataFrame, folder: str) -> None:
    """The audit's summary as quality_summary.csv and .json: a row for each dataset and language, so it is collected."""
    rows = [r.asDict(recursive=True) for r in summary.orderBy("dataset", "lang").collect()]
    files.write_text(summary.sparkSession, f"{folder}/quality_summary.json", json.dumps(rows, ensure_ascii=False, indent=2))
    table = io.StringIO(newline="")
    writer = csv.DictWriter(table, summary.columns, lineterminator="\n")
    writer.writeheader()
    writer.writerows({k: json.dumps(v, ensure_ascii=False) if isinstance(v, (list, dict)) else v for k, v in r.items()} for r in rows)
    files.write_text(summary.sparkSession, f"{folder}/quality_summary.csv", table.getvalue())
