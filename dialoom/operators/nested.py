"""Texts at paths of nested values: found, and put back, by a walk over the schema. Everything stays an expression over one row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

ENTRY = "array<struct<path:string,text:string>>"


def none() -> Column:
    return F.array().cast(ENTRY)


def segments(path: str) -> list[str]:
    """`a.b[].c` as the steps a, b, [], c."""
    out = []
    for part in path.split("."):
        if part.endswith("[]"):
            out += [part[:-2], "[]"] if part != "[]" else ["[]"]
        elif part:
            out.append(part)
    return out


def text_of(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def indexed(label: Column, i: Column) -> Column:
    return F.concat(label, F.lit("["), i.cast("string"), F.lit("]"))


def texts_at(kind: DataType, value: Column, steps: list[str], label: Column) -> Column:
    """array<struct<path, text>> of what is at one path, in order. A key ends a path; a list is stepped into by []; what is not there has no entry."""
    if not steps:
        return none()
    step, rest = steps[0], steps[1:]
    if step == "[]":
        if not isinstance(kind, ArrayType):
            return none()
        inner = F.transform(value, lambda x, i: texts_at(kind.elementType, x, rest, indexed(label, i)))
        return F.coalesce(F.flatten(inner), none())
    if not isinstance(kind, StructType) or step not in kind.names:
        return none()
    here = F.concat(label, F.lit(f".{step}"))
    if rest:
        return texts_at(kind[step].dataType, value[step], rest, here)
    return F.when(value.isNotNull(), F.array(F.struct(here.alias("path"), text_of(value[step]).alias("text")))).otherwise(none())


def texts_at_paths(kind: DataType, value: Column, paths: list[str]) -> Column:
    """The texts at all paths, path by path; a path that is named twice counts once."""
    return reduce(F.concat, [texts_at(kind, value, segments(p), F.lit("")) for p in dict.fromkeys(paths)] or [none()])


def replaced(kind: DataType, value: Column, paths: list[list[str]], label: Column, new: Column) -> Column:
    """The value with the strings at these paths taken from a map of labels; null ones stay null, and so does all else."""
    if isinstance(kind, ArrayType):
        deeper = [p[1:] for p in paths if len(p) > 1 and p[0] == "[]"]
        return F.transform(value, lambda x, i: replaced(kind.elementType, x, deeper, indexed(label, i), new)) if deeper else value
    if isinstance(kind, StructType):
        for field in kind:
            mine = [p[1:] for p in paths if p and p[0] == field.name]
            here = F.concat(label, F.lit(f".{field.name}"))
            if [] in mine and isinstance(field.dataType, StringType):
                old = value[field.name]
                value = F.when(value.isNotNull(), value.withField(field.name, F.when(old.isNotNull(), F.coalesce(F.try_element_at(new, here), old))))
            elif any(mine):
                value = F.when(value.isNotNull(), value.withField(field.name, replaced(field.dataType, value[field.name], [p for p in mine if p], here, new)))
    return value


def leaf_paths(kind: DataType, exclude: frozenset = frozenset()) -> list[list[str]]:
    """Steps to every string of a type, without those under excluded keys. Strings in lists of strings have [] as their last step."""
    if isinstance(kind, StringType):
        return [[]]
    if isinstance(kind, ArrayType):
        return [["[]", *p] for p in leaf_paths(kind.elementType, exclude)]
    if isinstance(kind, StructType):
        return [[f.name, *p] for f in kind if f.name not in exclude for p in leaf_paths(f.dataType, exclude)]
    return []


def replaced_leaves(kind: DataType, value: Column, label: Column, new: Column, exclude: frozenset = frozenset()) -> Column:
    """The value with every string whose label is in the map replaced."""
    if isinstance(kind, StringType):
        return F.when(value.isNotNull(), F.coalesce(F.try_element_at(new, label), value))
    if isinstance(kind, ArrayType) and leaf_paths(kind, exclude):
        return F.transform(value, lambda x, i: replaced_leaves(kind.elementType, x, indexed(label, i), new, exclude))
    if isinstance(kind, StructType):
        for field in kind:
            if field.name not in exclude and leaf_paths(field.dataType, exclude):
                here = F.when(label == "", F.lit(field.name)).otherwise(F.concat(label, F.lit(f".{field.name}")))
                value = F.when(value.isNotNull(), value.withField(field.name, replaced_leaves(field.dataType, value[field.name], here, new, exclude)))
    return value
