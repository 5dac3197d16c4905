"""Command line: `python -m dialoom.cli COMMAND ...`: check, translate, reformat, inspect, evaluate, benchmark-judge, check-fix, upload, audit, config-show."""

from __future__ import annotations

import argparse
import json
from functools import reduce
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config
from .functions import text as T
from .operators import align, audit, checks, evaluation, export, fixes, metrics, report, runs, sampling, stats, strategies
from .operators.answers import AnswerLog
from .operators.pairs import aligned, inferred_rules, text_pairs
from .operators.ranges import RangeLog
from .sources import files
from .sources.tables import export_all, fingerprints, limited, manifest, push_commands, read_text, renamed_splits, with_passthrough, write_manifest, write_report, write_splits

KEYS = ["split", "row_idx", "pair_ord", "field"]


def other_issues(every: DataFrame, checked: DataFrame, settings: config.DatasetConfig) -> DataFrame:
    """Issues that are not of one pair's text: values that do not fit each other, changed actions, repeated translations."""
    keys = KEYS
    said = [T.truncated(F.col(c)).alias(c) for c in ("source", "translation")]
    kind = lambda severity, code, order: [F.lit(order).alias("check_ord"), F.lit(severity).alias("severity"), (F.lit(code) if isinstance(code, str) else code).alias("code")]
    code = F.when(F.contains("error", F.lit("length mismatch")), "list_length_mismatch").otherwise("field_type_mismatch")
    broken = every.where("error is not null").select(*keys, *kind("error", code, -1), *said, F.col("error").alias("message"))
    queries = [k for k, rule in enumerate(settings.rules) if rule.strategy == "weblinx_query"]
    actions = checks.action_changes(checked.where(F.col("rule_ord").isin(queries))).select(*keys, *kind("error", "weblinx_action_changed", 98), *said)
    repeated = checks.repeated_translations(checked.withColumn("row_idx", F.struct("split", "row_idx")))
    note = F.format_string("stands for %s distinct sources", F.col("distinct_sources")).alias("message")
    repeats = repeated.select("row_idx.split", "row_idx.row_idx", F.lit(0).alias("pair_ord"), F.col("root").alias("field"), *kind("warning", "repeated_translation", 99), F.lit(None).cast("string").alias("source"), said[1], note)
    return broken.unionByName(actions, allowMissingColumns=True).unionByName(repeats, allowMissingColumns=True)


def run_check(spark: SparkSession, settings: config.DatasetConfig, source_path: str, translated_path: str, out: str, max_rows: int = 0, most: int = 200) -> int:
    """Audit a translated dataset against its source; 1 if there are errors. Both have split and row_idx. Writes summary, issues, suppressed pairs and metrics."""
    source = renamed_splits(spark.read.parquet(source_path), settings.split_map)
    target = spark.read.parquet(translated_path)
    out = f"{out}-sample-{max_rows}" if max_rows > 0 else out
    if missing := checks.missing_fields(source.columns, target.columns, settings.rules):
        write_report({"verdict": "fail", "missing_fields": missing}, f"{out}/summary.json")
        return 1
    every = text_pairs(aligned(*limited(source, target, max_rows)), list(settings.rules))
    checked = checked_by_rule(every, settings).persist(StorageLevel.DISK_ONLY)
    more = other_issues(every, checked, settings).persist(StorageLevel.DISK_ONLY)
    issues = checks.issues_of(checked, KEYS).unionByName(more, allowMissingColumns=True)
    found = report.quality_report(checked, issues, more, most)
    found["splits_differ"] = [r.asDict() for r in checks.split_issues(source, target, tuple(p.output_split for p in settings.passthrough)).collect()]
    suppressed = checked.where("suppressed is not null")
    found["suppressed"] = suppressed.count()
    issues.write.mode("overwrite").parquet(f"{out}/issues")
    suppressed.select(*KEYS, T.truncated(F.col("source")).alias("source"), F.col("suppressed").alias("reason")).write.mode("overwrite").parquet(f"{out}/suppressed")
    metrics.field_rows(checked, more).write.mode("overwrite").parquet(f"{out}/metrics")
    write_report(found, f"{out}/summary.json")
    files.write_text(spark, f"{out}/report.html", report.html_page(found, "Translation quality"))
    checked.unpersist()
    more.unpersist()
    print(report.text_summary(found))
    return int(found["errors"] > 0 or any(s["severity"] == "error" for s in found["splits_differ"]))


def checked_by_rule(every: DataFrame, settings: config.DatasetConfig) -> DataFrame:
    """The pairs checked as their rules ask for: titles that may stay, and the least letters of a text that may not."""
    kinds: dict[tuple, list[int]] = {}
    for k, rule in enumerate(settings.rules):
        kinds.setdefault((bool(rule.options.get("allow_unchanged_title_like", False)), int(rule.options.get("unchanged_min_letters", checks.MIN_UNCHANGED_LETTERS))), []).append(k)
    good = every.where("error is null")
    parts = [checks.check_pairs(good.where(F.col("rule_ord").isin(rules)), *kind) for kind, rules in kinds.items()]
    return reduce(DataFrame.unionByName, parts)


def run_translate(spark: SparkSession, settings: config.DatasetConfig, source_path: str, out: str) -> int:
    """Translate a dataset, with a manifest beside it; 1 if a split failed and that is not allowed, in which case only the records are kept.

    Records are kept by ranges of rows and answers by request, so a run that was ended is taken up where it was: rows of ranges
    that are there are not read again, and nothing that was answered is sent again. Rows that failed are.
    """
    source = spark.read.parquet(source_path)
    rules, policy = list(settings.rules), settings.policy
    if wrong := strategies.problems(source, rules):
        raise ValueError("; ".join(wrong))
    said = json.dumps([[[r.source, r.target, r.strategy, r.options] for r in rules], settings.translator, list(settings.languages), source_path], sort_keys=True)
    if (files.read_text(spark, f"{out}/run.json") or said) != said:
        raise ValueError(f"{out} holds a run of other rules, services or rows")
    files.write_text(spark, f"{out}/run.json", said)
    rows = source.where(F.col("row_idx") < policy.max_rows) if policy.max_rows > 0 else source
    answers, log = AnswerLog(spark, f"{out}/answers"), RangeLog(spark, f"{out}/records", policy.batch_size)
    calls = {"retries": policy.retries, "sleep": policy.sleep, "per_minute": policy.requests_per_minute, "concurrency": policy.concurrency, "source": settings.languages[0], "target": settings.languages[1]}
    log.run(rows, lambda part: strategies.translated(part, rules, settings.translator, answers=answers, **calls), ended=answers.end)
    records = log.records()
    if records is None:  # no rows at all
        records = strategies.translated(rows, rules, settings.translator, answers=answers, **calls)
    try:
        failed = runs.gated(records, settings.policy.allow_errors)
    except RuntimeError as e:
        print(e)
        return 1
    made = list(dict.fromkeys(r.target for r in rules))
    kept = runs.materialised(rows, records, made, settings.drop_columns)
    kept = with_passthrough(kept, [(spark.read.parquet(p.path), p.source_split, p.output_split) for p in settings.passthrough])
    write_splits(kept, f"{out}/dataset")
    marks = {r.split: r.fingerprint for r in fingerprints(source).collect()}
    write_manifest({**manifest("translation", source_path, Path(out).name, settings.languages[1], marks), "failed_splits": failed}, out)
    print(f"translated {records.count()} rows, failed splits: {', '.join(failed) or 'none'}")
    return 0


def run_reformat(spark: SparkSession, spec: config.ReformatConfig, source_path: str, out: str, inspect: bool = False) -> int:
    """Every candidate corpus put into the source's rows, or only inspected; a candidate's failure is its status."""
    source = spark.read.parquet(source_path)
    if wrong := evaluation.reformat_preflight(source, [spec.dialogue_id, spec.text, spec.history], spec.root, spec.candidates):
        print("\n".join(wrong))
        return 1
    rows = source.withColumnsRenamed({spec.dialogue_id: "dialogue_id", spec.text: "text", spec.history: "history"})

    def process(name: str, path: str) -> tuple[dict, DataFrame | None]:
        external = align.candidate_dialogues(spark, f"{spec.root}/{path}")
        own = rows.withColumn("dialogue_id", T.strip_prefix(F.col("dialogue_id"), list(spec.prefixes)))
        if inspect:
            return align.coverage_report(own, external, spec.turns_per_row), None
        done = align.reformatted(rows, external, spec.turns_per_row, spec.offset, tuple(spec.roles), spec.missing, tuple(spec.prefixes), name)
        write_splits(done.withColumnsRenamed({"dialogue_id": spec.dialogue_id, "text": spec.text, "history": spec.history}), f"{out}/{name}")
        found = align.reformat_summary(own, external, spark.read.parquet(f"{out}/{name}"), spec.turns_per_row)
        return {"splits": [r.asDict() for r in found.orderBy("split").collect()]}, None

    statuses = runs.run_candidates(spark, dict(spec.candidates), f"{out}/candidates", process)
    print(json.dumps(statuses, ensure_ascii=False))
    return int(any(s != "ok" for s in statuses.values()))


def run_evaluate(spark: SparkSession, payload: dict, out: str) -> int:
    """Sample, look up, judge; records that are ok are not judged again."""
    spec, policy = evaluation_from(payload), config.only(config.JudgePolicy, payload.get("policy", {}))
    inputs = evaluation.load_inputs(spark, spec)
    if wrong := evaluation.preflight(spec, inputs):
        print("\n".join(wrong))
        return 1
    rows, k, seed = inputs[spec.sample_dataset], int(payload.get("samples", 0)), int(payload.get("seed", 42))
    rows = rows if spec.split == "all" else rows.where(F.col("split") == spec.split)
    if spec.stratify_by:
        chosen = sampling.stratified(rows, spec.stratify_by, k, seed).select("split", "row_idx", F.col("value").alias("group_value"), "group_count")
    else:
        sizes = rows.groupBy("split").agg(F.count("*").alias("group_count"))
        chosen = sampling.per_split(rows, k, seed).select("split", "row_idx", F.lit("").alias("group_value")).join(sizes, "split")
    tasks = evaluation.evaluation_tasks(chosen, inputs, spec)
    template = read_text(payload["prompt"]) if payload.get("prompt") else evaluation_template
    records = runs.run_records(spark, tasks, f"{out}/records", ["sample_id"], lambda todo: evaluation.evaluation_records(todo, spec, payload.get("judge", "length"), template, payload.get("model", ""), **policy.calls()))
    rows_of = lambda df: [r.asDict() for r in df.collect()]
    found = {"scores": rows_of(stats.evaluation_summary(records, ["field", "split", "sample_group_value"])), "means": rows_of(stats.group_means(records, "sample_group_value", "sample_group_count")), "statuses": rows_of(stats.status_counts(records))}
    write_report(found, f"{out}/summary.json")
    print(json.dumps(found["statuses"], ensure_ascii=False))
    return 0


evaluation_template = 'Rate this translation from {source_lang} to {target_lang} ({domain}) from 0 to 100.\nSource:\n{source_text}\nTranslation:\n{translation}\nAnswer with JSON: {"score": 0, "comment": ""}'


def evaluation_from(payload: dict) -> evaluation.Evaluation:
    inputs = {name: evaluation.Input(**ref) for name, ref in payload["inputs"].items()}
    pairs = tuple(evaluation.FieldPair(**p) for p in payload["field_pairs"])
    known = {"sample_dataset", "source_lang", "target_lang", "domain", "split", "stratify_by", "raw_path", "translated_root", "translated_name", "run_name", "dataset_id"}
    return evaluation.Evaluation(inputs, pairs, **{k: payload[k] for k in known & set(payload)})


def run_benchmark(spark: SparkSession, payload: dict, rows_path: str, out: str) -> int:
    """Judges against human scores: rows (dataset_idx, lp, src, mt, score, and domain and year where filtered by)."""
    lists = ("models", "language_pairs", "domains", "years", "sampling_thresholds", "thresholds", "labels")
    spec = config.only(config.BenchmarkConfig, {k: tuple(v) if k in lists else v for k, v in payload.items() if k not in ("judge", "prompt", "name", "policy")})
    policy = config.only(config.JudgePolicy, payload.get("policy", {}))
    rows = sampling.benchmark_rows(spark.read.parquet(rows_path), list(spec.language_pairs), list(spec.domains), list(spec.years), spec.max_source, spec.max_translation)
    chosen = sampling.benchmark_sample(rows, spec.per_pair, spec.total, list(spec.sampling_thresholds), spec.seed)
    labels = list(spec.labels) or [f"bin_{i}" for i in range(len(spec.thresholds) + 1)]
    template = read_text(payload["prompt"]) if payload.get("prompt") else evaluation_template
    judged = evaluation.benchmark_records(chosen, list(spec.models), payload.get("judge", "length"), template, list(spec.thresholds), labels, payload.get("name", "benchmark"), **policy.calls())
    judged.write.mode("overwrite").parquet(f"{out}/records")
    found = [r.asDict(recursive=True) for r in stats.benchmark_summary(spark.read.parquet(f"{out}/records"), labels).orderBy("model", F.col("lp").asc_nulls_first()).collect()]
    write_report({"models": found}, f"{out}/summary.json")
    print(json.dumps([{k: r[k] for k in ("model", "lp", "n", "pearson")} for r in found], ensure_ascii=False))
    return 0


def run_fix(spark: SparkSession, issues_path: str, judge: str, languages: list[str], out: str, most: int, policy: config.JudgePolicy = config.JudgePolicy()) -> int:
    """Suggestions for the fixable issues of a check."""
    done = fixes.suggestions(fixes.cases(spark.read.parquet(issues_path), most), judge, *languages, **policy.calls())
    done.write.mode("overwrite").parquet(f"{out}/suggestions")
    found = fixes.summary(spark.read.parquet(f"{out}/suggestions"))
    write_report(found, f"{out}/summary.json")
    print(fixes.text_summary(found))
    return 0


def run_upload(spark: SparkSession, root: str, names: list[str], every: bool, out: str, push: bool, yes: bool) -> int:
    """Export datasets by their configurations; pushing only says what would be run."""
    there = sorted(p.stem for p in Path(root, "uploads").glob("*.y*ml")) + sorted(p.stem for p in Path(root, "uploads").glob("*.json"))
    chosen = there if every else names
    if not chosen:
        raise SystemExit("--all or at least one --upload is needed")
    if unknown := sorted(set(chosen) - set(there)):
        raise SystemExit(f"unknown uploads: {', '.join(unknown)}")
    for name in chosen:
        payload = config.named(f"{root}/uploads", name)
        sources = payload.get("sources") or [{"config_name": payload["export"].get("config_name", "default"), "path": payload["source"]["path"]}]
        datasets = {s["config_name"]: spark.read.parquet(s["path"]) for s in sources}
        rows = export_all(datasets, payload["export"], f"{out}/{name}", export.reshape)
        print(f"{name}: {sum(n for splits in rows.values() for n in splits.values())} rows")
        if push:
            for command in push_commands(payload["repo"], f"{out}/{name}", yes):
                print(" ".join(command))
    return 0


def run_plan(spark: SparkSession, args: argparse.Namespace) -> int:
    """Audit the datasets of a plan; 1 if a task failed. What is recorded is not done again."""
    found = audit.audit_plan(spark, args.plan, args.data, args.out, args.exclude, args.limit_tasks, args.reset, args.at_once)
    for r in found:
        label = f"{r['dataset']} {r['lang']} {r['target_config']}/{r['target_split']}"
        print(f"{label}: rows={r['checked_rows']} issue_rows={r['issue_rows']} errors={r['errors']} warnings={r['warnings']}" if r["status"] == "ok" else f"{label}: {r['status']}: {r['error']}")
    return int(any(r["status"] == "failed" for r in found))


def check_settings(args: argparse.Namespace) -> config.DatasetConfig:
    """The rules of a check, by exactly one of: a dataset's configuration, a quality configuration, a dataset alone (rules by column names)."""
    if sum(map(bool, (args.config, args.quality, args.infer))) != 1:
        raise SystemExit("exactly one of --config, --quality and --infer is needed")
    if args.config:
        return config.from_mapping(config.overridden(config.load(args.config), args.set))
    if args.quality:
        spec = config.quality_from(config.overridden(config.named(f"{args.root}/quality", args.quality), args.set))
        return config.DatasetConfig(config.quality_rules(spec, args.root), split_map=spec.split_map)
    columns = SparkSession.builder.getOrCreate().read.parquet(args.translated).columns
    return config.DatasetConfig(tuple(inferred_rules(columns, f"_{args.infer}")))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="dialoom")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, **needed: bool) -> argparse.ArgumentParser:
        found = commands.add_parser(name)
        for option, must in needed.items():
            found.add_argument(f"--{option.replace('_', '-')}", required=must, default="")
        found.add_argument("--set", action="append", default=[], help="a.b=value")
        return found

    check = command("check", config=False, quality=False, infer=False, source=False, translated=True, out=True)
    check.add_argument("--root", default="conf")
    check.add_argument("--max-rows-per-split", type=int, default=0)
    check.add_argument("--max-issues", type=int, default=200)
    command("translate", config=True, source=True, out=True)
    command("reformat", config=True, source=True, out=True)
    command("inspect", config=True, source=True, out=True)
    command("evaluate", config=True, out=True)
    command("benchmark-judge", config=True, rows=True, out=True)
    fix = command("check-fix", issues=True, judge=True, out=True)
    fix.add_argument("--languages", nargs=2, default=["en", "fr"])
    fix.add_argument("--max-fixes", type=int, default=50)
    upload = command("upload", out=True)
    upload.add_argument("--root", default="conf")
    upload.add_argument("--upload", action="append", default=[])
    for flag in ("all", "push", "yes"):
        upload.add_argument(f"--{flag}", action="store_true")
    command("config-show", config=True)
    plan = command("audit", plan=True, data=True, out=True)
    plan.add_argument("--exclude", action="append", default=[], help="DATASET:LANG[,LANG]")
    plan.add_argument("--limit-tasks", type=int, default=0)
    plan.add_argument("--at-once", type=int, default=4)
    plan.add_argument("--reset", action="store_true")
    return top


def main(arguments: list[str] | None = None) -> int:
    args = parser().parse_args(arguments)
    if args.command == "check":
        settings = check_settings(args)
        return run_check(SparkSession.builder.getOrCreate(), settings, args.source or args.translated, args.translated, args.out, args.max_rows_per_split, args.max_issues)
    if args.command == "audit":
        return run_plan(SparkSession.builder.getOrCreate(), args)
    payload = config.overridden(config.load(args.config), args.set) if getattr(args, "config", "") else {}
    if args.command == "config-show":
        print(config.from_mapping(payload))
        return 0
    spark = SparkSession.builder.getOrCreate()
    if args.command == "translate":
        return run_translate(spark, config.from_mapping(payload), args.source, args.out)
    if args.command in ("reformat", "inspect"):
        spec = config.only(config.ReformatConfig, {k: tuple(v) if isinstance(v, list) else v for k, v in payload.items()})
        return run_reformat(spark, spec, args.source, args.out, args.command == "inspect")
    if args.command == "evaluate":
        return run_evaluate(spark, payload, args.out)
    if args.command == "benchmark-judge":
        return run_benchmark(spark, payload, args.rows, args.out)
    if args.command == "check-fix":
        return run_fix(spark, args.issues, args.judge, args.languages, args.out, args.max_fixes, config.only(config.JudgePolicy, config.overridden({}, args.set).get("policy", {})))
    return run_upload(spark, args.root, args.upload, args.all, args.out, args.push, args.yes)


if __name__ == "__main__":
    raise SystemExit(main())
