"""Reshaping for export: a chain of named column transforms."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replace_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumns({target: F.col(source) for target, source in mapping.items()})


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


def select_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns)


def serialized_dialog_content(df: DataFrame, source: str, translated: str, content: str = "content", translated_content: str = "content_fr", keep: bool = False) -> DataFrame:
    """JSON turns whose text is that of the translated turns at the same place, as many as both have."""
    items = lambda c: F.from_json(F.coalesce(F.col(c), F.lit("[]")), "array<variant>")
    a, b = items(source), items(translated)
    n = F.least(F.size(a), F.size(b))
    both = F.arrays_zip(F.slice(a, F.lit(1), n).alias("a"), F.slice(b, F.lit(1), n).alias("b"))
    is_turn = lambda v: F.schema_of_variant(v).startswith("OBJECT")
    mapping = lambda v: F.from_json(F.to_json(v), "map<string,variant>")

    def turn(p):
        said = F.try_variant_get(p["b"], f"$.{translated_content}", "variant")
        there = F.map_contains_key(mapping(p["b"]), translated_content)
        new = F.map_concat(F.map_filter(mapping(p["a"]), lambda k, _: ~k.isin(content, translated_content) if keep else k != content), F.create_map(F.lit(content), said))
        new = F.map_concat(new, F.create_map(F.lit(translated_content), said)) if keep else new
        # a turn that is no mapping, or whose translation has no text, stays as it is
        return F.when(is_turn(p["a"]) & is_turn(p["b"]) & there, F.to_json(new)).otherwise(F.to_json(p["a"]))

    done = F.concat(F.lit("["), F.array_join(F.transform(both, turn), ","), F.lit("]"))
    return df.withColumn(source, F.when(a.isNull() | b.isNull(), F.raise_error(F.lit("a JSON list is needed"))).otherwise(done))


TRANSFORMS: dict[str, Callable[..., DataFrame]] = {f.__name__: f for f in (replace_columns, drop_columns, select_columns, serialized_dialog_content)}


def reshape(df: DataFrame, steps: list[tuple[str, dict]]) -> DataFrame:
    """The steps in order; an unknown name is an error."""
    for name, _ in steps:
        if name not in TRANSFORMS:
            raise ValueError(f"unknown transform {name!r}")
    return reduce(lambda d, step: TRANSFORMS[step[0]](d, **step[1]), steps, df)
