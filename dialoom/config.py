"""Configured work: rules of a dataset, quality checks, exports, benchmarks, and the policies of a run. Files are YAML or JSON."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields
from pathlib import Path

from .operators.pairs import Rule

# Names of strategies.
STRATEGIES = ("auto", "text", "text_list", "dialog_turns_content", "serialized_dialog_turns_content", "serialized_text_list", "structured_entity", "nested_text_fields", "deep_map_texts", "weblinx_query")


def load(path: str) -> dict:
    """A configuration file; YAML (of which JSON is a part) where its reader is there."""
    body = Path(path).read_text(encoding="utf-8")
    if path.endswith((".yaml", ".yml")):
        import yaml

        found = yaml.safe_load(body)
    else:
        found = json.loads(body)
    if not isinstance(found, dict):
        raise ValueError(f"{path}: a mapping is needed")
    return found


def named(folder: str, name: str) -> dict:
    """The configuration of a name in a folder."""
    for suffix in (".yaml", ".yml", ".json"):
        if (at := Path(folder, name + suffix)).exists():
            return load(str(at))
    raise FileNotFoundError(f"no configuration {name!r} in {folder}")


def overridden(payload: dict, changes: list[str]) -> dict:
    """With values set by `a.b.c=value`; a value is read as JSON where it is JSON."""
    out = json.loads(json.dumps(payload))
    for change in changes:
        path, sign, raw = change.partition("=")
        if not sign:
            raise ValueError(f"expected key=value, got {change!r}")
        try:
            value = json.loads(raw)
        except ValueError:
            value = raw
        *above, last = path.split(".")
        at = out
        for key in above:
            at = at.setdefault(key, {})
            if not isinstance(at, dict):
                raise ValueError(f"{path}: {key!r} is no mapping")
        at[last] = value
    return out


def only(kind: type, payload: dict):
    """A dataclass from a mapping without unknown keys."""
    if unknown := sorted(set(payload) - {f.name for f in fields(kind)}):
        raise ValueError(f"{kind.__name__}: unknown keys {unknown}")
    return kind(**payload)


@dataclass(frozen=True)
class RunPolicy:
    concurrency: int = 4
    retries: int = 5
    sleep: float = 2.0
    batch_size: int = 1000
    requests_per_minute: int = 0
    max_rows: int = 0
    allow_errors: bool = False

    def __post_init__(self):
        if self.concurrency < 1 or self.retries < 0 or self.batch_size < 1:
            raise ValueError("concurrency and batch_size are at least 1, retries at least 0")


@dataclass(frozen=True)
class JudgePolicy:
    """How judges are called. The numbers are fixed values: what a run has that says nothing else."""

    concurrency: int = 48
    retries: int = 3
    sleep: float = 5.0
    requests_per_minute: int = 60
    max_completion_tokens: int = 200

    def __post_init__(self):
        if self.concurrency < 1 or self.retries < 0 or self.max_completion_tokens < 1:
            raise ValueError("concurrency and max_completion_tokens are at least 1, retries at least 0")

    def calls(self) -> dict:
        return {"retries": self.retries, "sleep": self.sleep, "per_minute": self.requests_per_minute, "concurrency": self.concurrency, "max_tokens": self.max_completion_tokens}


@dataclass(frozen=True)
class Passthrough:
    """A split of another dataset that goes along as it is."""

    path: str
    source_split: str
    output_split: str


@dataclass(frozen=True)
class DatasetConfig:
    rules: tuple[Rule, ...]
    drop_columns: tuple[str, ...] = ()
    split_map: dict = field(default_factory=dict)
    policy: RunPolicy = RunPolicy()
    translator: str = "prefix"
    languages: tuple[str, str] = ("en", "fr")
    passthrough: tuple[Passthrough, ...] = ()

    def __post_init__(self):
        targets = [r.target for r in self.rules]
        if len(set(targets)) < len(targets):
            raise ValueError("targets are not unique")
        if set(targets) & set(self.drop_columns):
            raise ValueError("a target is dropped")
        unknown = {r.strategy for r in self.rules} - set(STRATEGIES)
        if unknown:
            raise ValueError(f"unknown strategies {sorted(unknown)}")


def rules_of(payload: list[dict]) -> tuple[Rule, ...]:
    return tuple(Rule(r["source"], r.get("target") or r["source"], r.get("strategy", "auto"), dict(r.get("options", {}))) for r in payload)


def from_mapping(payload: dict) -> DatasetConfig:
    known = {"rules", "drop_columns", "split_map", "policy", "translator", "languages", "passthrough"}
    if set(payload) - known:
        raise ValueError(f"unknown keys {sorted(set(payload) - known)}")
    return DatasetConfig(
        rules_of(payload["rules"]), tuple(payload.get("drop_columns", ())), dict(payload.get("split_map", {})), only(RunPolicy, payload.get("policy", {})),
        payload.get("translator", "prefix"), tuple(payload.get("languages", ("en", "fr"))), tuple(only(Passthrough, p) for p in payload.get("passthrough", ())),
    )


@dataclass(frozen=True)
class ReformatConfig:
    """How an external corpus takes the place of text and history."""

    dialogue_id: str = "dialogue_id"
    text: str = "text"
    history: str = "history"
    content_field: str = "content"
    turns_per_row: int = 2
    offset: int = 0
    roles: tuple[str, ...] = ("user", "assistant")
    prefixes: tuple[str, ...] = ()
    missing: str = "skip_dialogues"
    root: str = ""
    candidates: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.turns_per_row < 1:
            raise ValueError("turns_per_row is at least 1")
        if self.missing not in ("skip_dialogues", "keep_source"):
            raise ValueError(f"unknown policy {self.missing!r}")


def reformat_rules(spec: ReformatConfig) -> tuple[Rule, ...]:
    """What a check of a reformatted dataset compares."""
    return (Rule(spec.text, spec.text, "text"), Rule(spec.history, spec.history, "dialog_turns_content", {"content_field": spec.content_field}))


@dataclass(frozen=True)
class QualityConfig:
    """A check: rules of its own, or those of a dataset, whose targets an export may have renamed."""

    rules: tuple[Rule, ...] = ()
    rules_from: dict = field(default_factory=dict)
    split_map: dict = field(default_factory=dict)

    def __post_init__(self):
        if bool(self.rules) == bool(self.rules_from):
            raise ValueError("either rules or rules_from is needed")


def renamed_targets(rules: tuple[Rule, ...], transforms: list[dict]) -> tuple[Rule, ...]:
    """Rules for an exported dataset: a target that an export put into another column is looked for there."""
    to: dict[str, str] = {}
    for step in transforms:
        if step.get("name") == "replace_columns":
            to |= {source: target for target, source in (step.get("columns") or {}).items()}
        elif step.get("name") == "serialized_dialog_content" and step.get("column") and step.get("translated_column"):
            to[step["translated_column"]] = step["column"]
    return tuple(Rule(r.source, to.get(r.target, r.target), r.strategy, dict(r.options)) for r in rules)


def export_transforms(export: dict, config_name: str = "") -> list[dict]:
    """The transforms of one config of an export."""
    layout = export.get("layout", "single_config")
    if layout == "single_config":
        own = export.get("config_name", "default")
        if config_name and config_name != own:
            raise ValueError(f"the export has the config {own!r}, not {config_name!r}")
        return list(export.get("transforms", ()))
    if layout != "multi_config":
        raise ValueError(f"unknown layout {layout!r}")
    if not config_name:
        raise ValueError("an export of several configs needs a config's name")
    for entry in export["configs"]:
        if entry["config_name"] == config_name:
            return list(entry.get("transforms", ()))
    raise ValueError(f"the export has no config {config_name!r}")


def quality_rules(spec: QualityConfig, root: str) -> tuple[Rule, ...]:
    """The rules that a check compares by: its own, or those of its dataset's translation, else of its reformat."""
    if spec.rules:
        return spec.rules
    source, workflow = named(f"{root}/datasets", spec.rules_from["dataset"]), spec.rules_from.get("workflow", "auto")
    rules: tuple[Rule, ...] = ()
    if workflow in ("auto", "translate") and source.get("rules"):
        rules = rules_of(source["rules"])
    elif workflow in ("auto", "reformat") and "reformat" in source:
        rules = reformat_rules(only(ReformatConfig, {**source["reformat"], **{k: tuple(source["reformat"][k]) for k in ("roles", "prefixes") if k in source["reformat"]}}))
    if not rules:
        raise ValueError(f"dataset {spec.rules_from['dataset']!r} has no rules for {workflow!r}")
    if export := spec.rules_from.get("upload"):
        rules = renamed_targets(rules, export_transforms(named(f"{root}/uploads", export)["export"], spec.rules_from.get("upload_config", "")))
    return rules


def quality_from(payload: dict) -> QualityConfig:
    known = {"rules", "rules_from", "split_map"}
    if set(payload) - known:
        raise ValueError(f"unknown keys {sorted(set(payload) - known)}")
    return QualityConfig(rules_of(payload.get("rules", [])), dict(payload.get("rules_from", {})), dict(payload.get("split_map", {})))


@dataclass(frozen=True)
class BenchmarkConfig:
    """A benchmark of judges: which rows, which models, how scores become bins."""

    models: tuple[str, ...]
    language_pairs: tuple[str, ...] = ()
    domains: tuple[str, ...] = ()
    years: tuple[int, ...] = ()
    max_source: int = 0
    max_translation: int = 0
    per_pair: int = 0
    total: int = 0
    sampling_thresholds: tuple[float, ...] = ()
    thresholds: tuple[float, ...] = (20, 40, 60, 80)
    labels: tuple[str, ...] = ()
    seed: int = 42

    def __post_init__(self):
        if list(self.thresholds) != sorted(self.thresholds):
            raise ValueError("thresholds ascend")
        if self.labels and len(self.labels) != len(self.thresholds) + 1:
            raise ValueError("one label more than thresholds")
