"""Aligned rows, and the text pairs in them."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from . import nested

KEYS = ["split", "row_idx"]


@dataclass(frozen=True)
class Rule:
    """A source column, the column with its translation, and how their values are compared."""

    source: str
    target: str
    strategy: str = "auto"
    options: dict = field(default_factory=dict)


#: Rows that are drawn to find where a table's blocks of rows begin.
BOUNDARY_SAMPLE = 2_000


def keyed(df: DataFrame, order: list[str], split: str | None = None, blocks: int = 0, nulls_last: bool = False) -> DataFrame:
    """With split and a dense row_idx inside it: the position by the order columns, as tables have none of their own.

    Nulls come first, as in Spark, or last, as in SQL engines.

    Rows are numbered in blocks, ranges of (split, order) that are about equal, and the rows of earlier blocks of the split are
    added; so no task sorts a whole split. Blocks begin at rows that are drawn by a hash, the same ones whenever a task runs again.
    """
    df = df.withColumn("split", F.col(split) if split else F.lit("train"))
    blocks = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [c for name in order for c in ([F.col(name).isNull().alias(f"_no_{name}"), F.col(name)] if nulls_last else [F.col(name)])]
    place = F.struct("split", *by)
    drawn = df.select(place.alias("place")).orderBy(F.xxhash64("place"), "place").limit(BOUNDARY_SAMPLE).collect()
    kind = df.select(place.alias("place")).schema["place"].dataType
    places = sorted({tuple((x is not None, x) for x in r.place): r.place for r in drawn}.items())
    starts = [r for _, r in places[:: max(1, len(places) // blocks)]][1:]
    literal = lambda r: F.struct(*(F.lit(x).cast(f.dataType).alias(f.name) for x, f in zip(r, kind, strict=True)))
    block = F.size(F.filter(F.array(*map(literal, starts)), lambda s: s <= place)) if starts else F.lit(0)
    dealt = df.withColumn("_keyed_block", block)
    counts = dealt.groupBy("split", "_keyed_block").agg(F.count("*").alias("_keyed_n"))
    earlier = F.sum("_keyed_n").over(Window.partitionBy("split").orderBy("_keyed_block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("split", "_keyed_block", F.coalesce(earlier, F.lit(0)).alias("_keyed_offset"))
    inside = F.row_number().over(Window.partitionBy("split", "_keyed_block").orderBy(*by)) - 1
    numbered = dealt.withColumn("_keyed_inside", inside).join(offsets.select(F.col("split").alias("_keyed_split"), F.col("_keyed_block").alias("_keyed_at"), "_keyed_offset"), F.col("split").eqNullSafe(F.col("_keyed_split")) & (F.col("_keyed_block") == F.col("_keyed_at")))
    return numbered.withColumn("row_idx", (F.col("_keyed_offset") + F.col("_keyed_inside")).cast("long")).select(*df.columns, "row_idx")


def aligned(source: DataFrame, target: DataFrame) -> DataFrame:
    """Row i of a split with row i of the same split, as far as both go: structs `src` and `tgt`."""
    side = lambda df, name: df.select(*KEYS, F.struct(*(c for c in df.columns if c not in KEYS)).alias(name))
    return side(source, "src").join(side(target, "tgt"), KEYS)


def inferred_rules(columns: list[str], suffix: str = "_fr") -> list[Rule]:
    return [Rule(c[: -len(suffix)], c) for c in columns if c.endswith(suffix) and c[: -len(suffix)] in columns]


def leaves(kind: DataType, value: Column, path: str = "", exclude: frozenset = frozenset()) -> Column:
    """array<struct<path, text>> of the non-blank texts in a nested value, by its schema."""
    entry = "array<struct<path:string,text:string>>"
    if isinstance(kind, StringType):
        return F.when(F.trim(F.coalesce(value, F.lit(""))) != "", F.array(F.struct(F.lit(path).alias("path"), value.alias("text")))).otherwise(F.array().cast(entry))
    if isinstance(kind, StructType):
        parts = [leaves(f.dataType, value[f.name], f"{path}.{f.name}" if path else f.name, exclude) for f in kind if f.name not in exclude]
        return reduce(F.concat, parts) if parts else F.array().cast(entry)
    if isinstance(kind, ArrayType):
        inner = lambda x, i: F.transform(leaves(kind.elementType, x, "", exclude), lambda e: F.struct(F.concat(F.lit(f"{path}["), i.cast("string"), F.lit("]"), F.when(e["path"] != "", F.concat(F.lit("."), e["path"])).otherwise("")).alias("path"), e["text"].alias("text")))
        return F.coalesce(F.flatten(F.transform(value, inner)), F.array().cast(entry))
    return F.array().cast(entry)


def zipped(left: Column, right: Column, path) -> Column:
    """array<struct<path, source, translation>> of two lists, as long as the shorter one."""
    n = F.least(F.size(left), F.size(right))
    both = F.arrays_zip(F.slice(left, F.lit(1), n).alias("source"), F.slice(right, F.lit(1), n).alias("translation"))
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.transform(both, lambda p, i: F.struct(path(i).alias("path"), text(p["source"]).alias("source"), text(p["translation"]).alias("translation")))


def pair_columns(rule: Rule, source: Column, target: Column, source_kind: DataType, target_kind: DataType) -> tuple[Column, Column]:
    """The pairs of a rule's two values, and the error in their structure (null if none)."""
    index = lambda i: F.concat(F.lit("["), i.cast("string"), F.lit("]"))
    length_error = lambda a, b: F.when(F.size(a) != F.size(b), F.format_string("list length mismatch: %s != %s", F.size(a), F.size(b)))
    none = F.lit(None).cast("string")
    content = rule.options.get("content_field", "content")
    if rule.strategy == "serialized_text_list":
        a, b = (F.from_json(c, "array<string>") for c in (source, target))
        bad = a.isNull() | b.isNull()
        return F.when(bad, F.lit(None)).otherwise(zipped(a, b, index)), F.when(bad, "JSON list expected").otherwise(length_error(a, b))
    if rule.strategy in ("dialog_turns_content", "serialized_dialog_turns_content"):
        out = rule.options.get("target_content_field", content)
        a, b = (F.from_json(c, "array<map<string,string>>") for c in (source, target)) if rule.strategy.startswith("serialized") else (source, target)
        bad = a.isNull() | b.isNull()
        at = lambda i: F.concat(index(i), F.lit(f".{out}"))
        return F.when(bad, F.lit(None)).otherwise(zipped(F.transform(a, lambda t: t[content]), F.transform(b, lambda t: t[out]), at)), F.when(bad, "list of turns expected").otherwise(length_error(a, b))
    if rule.strategy == "nested_text_fields":
        a, b = (nested.texts_at_paths(kind, value, list(rule.options.get("paths", ()))) for kind, value in ((source_kind, source), (target_kind, target)))
        both = zipped(F.transform(a, lambda e: e["text"]), F.transform(b, lambda e: e["text"]), lambda i: a[i]["path"])
        return both, F.when(F.size(a) != F.size(b), F.format_string("nested path count mismatch: %s -> %s", F.size(a), F.size(b)))
    if rule.strategy == "deep_map_texts":
        exclude = frozenset(rule.options.get("exclude_keys", ()))
        a, b = leaves(source_kind, source, exclude=exclude), leaves(target_kind, target, exclude=exclude)
        paths = lambda c: F.transform(c, lambda e: e["path"])
        both = F.filter(a, lambda e: F.array_contains(paths(b), e["path"]))
        pairs = F.transform(both, lambda e: F.struct(e["path"].alias("path"), e["text"].alias("source"), F.filter(b, lambda x: x["path"] == e["path"])[0]["text"].alias("translation")))
        missing, extra = F.array_except(paths(a), paths(b)), F.array_except(paths(b), paths(a))
        return pairs, F.when((F.size(missing) > 0) | (F.size(extra) > 0), F.concat(F.lit("missing paths "), F.array_join(F.slice(F.array_sort(missing), 1, 20), ","), F.lit(" extra paths "), F.array_join(F.slice(F.array_sort(extra), 1, 20), ",")))
    lists = isinstance(source_kind, ArrayType), isinstance(target_kind, ArrayType)
    if all(lists):
        return zipped(source, target, index), length_error(source, target)
    if any(lists):
        return F.lit(None), F.lit("one value is a list and the other is not")
    return F.array(F.struct(F.lit("").alias("path"), F.coalesce(source.cast("string"), F.lit("")).alias("source"), F.coalesce(target.cast("string"), F.lit("")).alias("translation"))), none


def text_pairs(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per pair (or structural error) of aligned rows: split, row_idx, rule_ord, pair_ord, field, source, translation, error.

    Narrow: rules are expressions over the aligned row, exploded once.
    """
    kinds = {side: {f.name: f.dataType for f in rows.schema[side].dataType} for side in ("src", "tgt")}
    entries = []
    for k, rule in enumerate(rules):
        pairs, error = pair_columns(rule, F.col("src")[rule.source], F.col("tgt")[rule.target], kinds["src"][rule.source], kinds["tgt"][rule.target])
        empty = F.array().cast("array<struct<path:string,source:string,translation:string>>")
        found = F.transform(F.coalesce(pairs.cast(empty_type()), empty), numbered(k, rule.target))
        broken = F.struct(F.lit(k).alias("rule_ord"), F.lit(-1).alias("pair_ord"), F.lit(rule.target).alias("field"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("translation"), error.alias("error"))
        entries.append(F.concat(F.when(error.isNotNull(), F.array(broken)).otherwise(F.array().cast("array<struct<rule_ord:int,pair_ord:int,field:string,source:string,translation:string,error:string>>")), found))
    return rows.select(*KEYS, F.explode(reduce(F.concat, entries)).alias("pair")).select(*KEYS, "pair.*")


def numbered(k: int, target: str):
    """A pair as an entry of rule k."""
    return lambda p, i: F.struct(F.lit(k).alias("rule_ord"), i.alias("pair_ord"), F.concat(F.lit(target), p["path"]).alias("field"), p["source"].alias("source"), p["translation"].alias("translation"), F.lit(None).cast("string").alias("error"))


def empty_type() -> str:
    return "array<struct<path:string,source:string,translation:string>>"
