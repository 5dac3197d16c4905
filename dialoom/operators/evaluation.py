"""Evaluation runs: inputs, checks before any call, samples with their texts, and records."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scoring as S
from .judge import judged, with_prompt
from .report import rendered


@dataclass(frozen=True)
class Input:
    """Where a dataset of an evaluation is: raw, translated, path or source."""

    kind: str
    path: str = ""
    run_name: str = ""


@dataclass(frozen=True)
class FieldPair:
    source_dataset: str
    source_field: str
    translation_dataset: str
    translation_field: str
    name: str = ""
    source_format: str = "text"
    translation_format: str = "text"

    @property
    def label(self) -> str:
        return self.name or self.translation_field


@dataclass(frozen=True)
class Evaluation:
    inputs: dict[str, Input]
    field_pairs: tuple[FieldPair, ...]
    sample_dataset: str
    source_lang: str = "en"
    target_lang: str = "fr"
    domain: str = "general"
    split: str = "all"
    stratify_by: str = ""
    raw_path: str = ""
    translated_root: str = "data/translated"
    translated_name: str = ""
    run_name: str = ""
    dataset_id: str = ""
    extra: dict = field(default_factory=dict)

    def __post_init__(self):
        if "translation" not in self.inputs:
            raise ValueError("an evaluation needs the input 'translation'")
        named = {self.sample_dataset} | {x for p in self.field_pairs for x in (p.source_dataset, p.translation_dataset)}
        if unknown := sorted(named - set(self.inputs)):
            raise ValueError(f"unknown inputs {unknown}")


def language_code_of(name: str) -> str:
    lower = name.strip().lower()
    return lower if lower in S.LANGUAGES else {v.lower(): k for k, v in S.LANGUAGES.items()}.get(lower, lower)


def input_path(spec: Evaluation, ref: Input) -> str | None:
    """The path of an input; None for the source itself, which is read by its own policy."""
    if ref.kind == "source":
        return None
    if ref.kind == "path" or ref.kind == "translated" and ref.path.strip():
        found = ref.path
    elif ref.kind == "raw":
        found = spec.raw_path
    elif ref.kind == "translated":
        parts = [spec.translated_root, language_code_of(spec.target_lang), spec.translated_name, ref.run_name or spec.run_name]
        found = "/".join(p for p in parts if p) if spec.translated_name else ""
    else:
        raise ValueError(f"unknown input kind {ref.kind!r}")
    if not found:
        raise ValueError(f"no path for an input of kind {ref.kind!r}")
    return found


def load_inputs(spark, spec: Evaluation, read_source: Callable[[], DataFrame] | None = None) -> dict[str, DataFrame]:
    """Every input as a table; a path that is not there is an error before any job."""
    jvm, conf, out = spark._jvm, spark._jsc.hadoopConfiguration(), {}
    for alias, ref in spec.inputs.items():
        path = input_path(spec, ref)
        if path is None:
            if read_source is None:
                raise ValueError(f"input {alias!r} is the source, which is not given")
            out[alias] = read_source()
            continue
        at = jvm.org.apache.hadoop.fs.Path(path)
        if not at.getFileSystem(conf).exists(at):
            raise FileNotFoundError(f"input {alias!r}: {path}")
        out[alias] = spark.read.parquet(path)
    return out


def manifest_problems(spec: Evaluation, alias: str, manifest: dict | None) -> list[str]:
    """What a dataset's side file says against using it."""
    if not manifest:
        return []
    said, ref, out = (lambda key: str(manifest.get(key, "")).strip()), spec.inputs[alias], []
    if said("dataset") and said("dataset") != spec.dataset_id:
        out.append(f"{alias}: dataset {said('dataset')!r}, expected {spec.dataset_id!r}")
    if said("lang") and language_code_of(said("lang")) != language_code_of(spec.target_lang):
        out.append(f"{alias}: language {said('lang')!r}, expected {spec.target_lang!r}")
    if ref.run_name and said("run") != ref.run_name:
        out.append(f"{alias}: run {said('run')!r}, expected {ref.run_name!r}")
    return out


def column_problems(spec: Evaluation, inputs: dict[str, DataFrame]) -> list[str]:
    """Columns that the evaluation needs and the schemas lack; no job is run."""
    needed: dict[str, set[str]] = {alias: set() for alias in inputs}
    if spec.stratify_by:
        needed[spec.sample_dataset].add(spec.stratify_by)
    for p in spec.field_pairs:
        needed[p.source_dataset].add(p.source_field)
        needed[p.translation_dataset].add(p.translation_field)
    return [f"{alias}: no column {c!r}" for alias in sorted(needed) for c in sorted(needed[alias] - set(inputs[alias].columns))]


def split_counts(spec: Evaluation, inputs: dict[str, DataFrame]) -> DataFrame:
    """alias, split, rows of every input in one pass over keys alone."""
    counted = [df.groupBy("split").agg(F.count("*").alias("rows")).select(F.lit(alias).alias("alias"), "split", "rows") for alias, df in sorted(inputs.items())]
    out = reduce(DataFrame.unionByName, counted)
    return out if spec.split == "all" else out.where(F.col("split") == spec.split)


def parity_problems(counts: DataFrame, spec: Evaluation) -> DataFrame:
    """alias pairs and splits whose row counts differ or that one side lacks: source, translation, split, source_rows, translation_rows."""
    spark = counts.sparkSession
    pairs = spark.createDataFrame(sorted({(p.source_dataset, p.translation_dataset) for p in spec.field_pairs}), "source string, translation string")
    wanted = pairs.crossJoin(counts.where(F.col("alias") == spec.sample_dataset).select("split"))  # a short list and the splits
    side = lambda name: counts.select(F.col("alias").alias(name), "split", F.col("rows").alias(f"{name}_rows"))
    both = wanted.join(side("source"), ["source", "split"], "left").join(side("translation"), ["translation", "split"], "left")
    return both.where(~F.col("source_rows").eqNullSafe(F.col("translation_rows")) | F.col("source_rows").isNull()).select("source", "translation", "split", "source_rows", "translation_rows")


def preflight(spec: Evaluation, inputs: dict[str, DataFrame], manifests: dict[str, dict] | None = None) -> list[str]:
    """Everything that speaks against a run; the counts are read only if the rest is fine."""
    out = column_problems(spec, inputs) + [x for alias in inputs for x in manifest_problems(spec, alias, (manifests or {}).get(alias))]
    if not out:
        out = [f"row count mismatch for split {r.split!r}: {r.source!r} has {r.source_rows}, {r.translation!r} has {r.translation_rows}" for r in parity_problems(split_counts(spec, inputs), spec).orderBy("source", "translation", "split").collect()]
    return out


def reformat_preflight(source: DataFrame, needed: list[str], root: str, candidates: dict[str, str]) -> list[str]:
    """Columns that a reformat needs, its folder, and its candidates' files."""
    spark = source.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def there(path: str) -> bool:
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(conf).exists(at)

    out = [f"no column {c!r}" for c in needed if c not in source.columns]
    if not there(root):
        return [*out, f"no folder {root}"]
    return out + [f"candidate {name!r} not found: {root}/{path}" for name, path in sorted(candidates.items()) if not there(f"{root}/{path}")]


def sample_id(*parts: Column) -> Column:
    return F.concat_ws(":", *(p.cast("string") for p in parts))


def evaluation_tasks(samples: DataFrame, inputs: dict[str, DataFrame], spec: Evaluation) -> DataFrame:
    """Every sample (split, row_idx, group_value, group_count) with the texts of every field pair, one row for each.

    Rows are looked up by (split, row_idx): a join of the sample's keys, so only sampled rows are rendered.
    """
    out = []
    for p in spec.field_pairs:
        text = lambda alias, column, kind, name: inputs[alias].select("split", "row_idx", rendered(F.col(column), kind).alias(name))
        both = samples.join(text(p.source_dataset, p.source_field, p.source_format, "source_text"), ["split", "row_idx"]).join(text(p.translation_dataset, p.translation_field, p.translation_format, "translation"), ["split", "row_idx"])
        names = {"field": p.label, "source_dataset": p.source_dataset, "source_field": p.source_field, "translation_dataset": p.translation_dataset, "translation_field": p.translation_field}
        out.append(both.withColumns({k: F.lit(v) for k, v in names.items()}))
    return reduce(DataFrame.unionByName, out).withColumn("sample_id", sample_id(F.col("split"), F.col("row_idx"), F.col("field")))


def ordered(records: DataFrame) -> DataFrame:
    """The order of records: split, group, row, field."""
    return records.orderBy("split", F.coalesce("group_value", F.lit("")), "row_idx", "field")


def evaluation_records(tasks: DataFrame, spec: Evaluation, judge: str, template: str, model: str = "", **policy) -> DataFrame:
    """A record of every task: its keys, texts, score, comment, status, and what the call used. A failed call is a record too. policy: of the calls, see judged."""
    rows = tasks.withColumns({"source_lang": F.lit(spec.source_lang), "target_lang": F.lit(spec.target_lang), "domain": F.lit(spec.domain)})
    names = {"source_text": "source_text", "translation": "translation", "source_lang": "source_lang", "target_lang": "target_lang", "domain": "domain", "reference_text": "reference_text"}
    names = {k: c for k, c in names.items() if c in rows.columns}
    done = judged(with_prompt(rows, template, names), judge, **policy)
    failed = F.col("error") != ""
    return done.withColumns({
        "dataset_id": F.lit(spec.dataset_id), "model": F.lit(model), "raw_response": F.coalesce("reply", F.lit("")),
        "parse_status": F.when(failed, "exception").otherwise(F.col("status")), "sample_group_value": F.col("group_value"), "sample_group_count": F.col("group_count"),
        **usage_columns(F.col("reply")),
    }).drop("prompt", "reply", "group_value", "group_count", "source_lang", "target_lang", "domain")


def usage_columns(reply: Column) -> dict[str, Column]:
    """What a reply that is a JSON object says of tokens and cost."""
    body = F.try_parse_json(reply)
    tokens = S.reported_tokens(body)
    return {"usage_prompt_tokens": tokens["prompt_tokens"], "usage_completion_tokens": tokens["completion_tokens"], "usage_total_tokens": tokens["total_tokens"], "usage_cost": S.reported_cost(body)}


def benchmark_records(samples: DataFrame, models: list[str], judge: str, template: str, thresholds: list[float], labels: list[str] | None = None, dataset: str = "", split: str = "", **policy) -> DataFrame:
    """Every sample (dataset_idx, lp, src, mt, score) judged by every model, with both scores binned; model by model."""
    spark = samples.sparkSession
    rows = samples.crossJoin(F.broadcast(spark.createDataFrame([(m,) for m in models], "model string")))  # a short list
    pair = F.split(S.language_pair(F.col("lp")), "-", 2)
    rows = rows.withColumns({"source_lang": S.language_name(F.get(pair, F.lit(0))), "target_lang": S.language_name(F.get(pair, F.lit(1))), "sample_id": sample_id(F.lit(dataset), F.lit(split), F.col("dataset_idx"))})
    rows = rows.withColumnsRenamed({"src": "source_text", "mt": "translation", "score": "human_score_raw"})
    names = {k: k for k in ("source_text", "translation", "source_lang", "target_lang", "domain", "reference_text") if k in rows.columns}
    done = judged(with_prompt(rows, template, names), judge, **policy).withColumnRenamed("score", "llm_score")
    binned = lambda c: S.score_bin(F.col(c), thresholds, labels)
    return done.withColumns({"human_bin": binned("human_score_raw"), "llm_bin": binned("llm_score"), **usage_columns(F.col("reply"))}).drop("prompt", "reply")


def read_manifest(path: str) -> dict | None:
    """The side file of a dataset; None if there is none or it is no JSON object."""
    from pathlib import Path

    at = Path(path)
    if not at.exists():
        return None
    found = json.loads(at.read_text(encoding="utf-8"))
    return found if isinstance(found, dict) else None
