"""Checks of text pairs. Each pair's issues come from one row of expressions; no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# Bounds of the checks.
MIN_UNCHANGED_LETTERS = 12
RESIDUE_TOKENS = 4
HEURISTIC_LETTERS = 250
RATIO_LOW, RATIO_HIGH, RATIO_LETTERS = 0.35, 3.0, 20
REPEAT_SOURCES, REPEAT_CHARS, REPEAT_EXAMPLES = 5, 500, 5


def with_facts(pairs: DataFrame, source: str = "source", translation: str = "translation", ascii_words: bool = False) -> DataFrame:
    """What the checks need of a pair, computed once: the generator keeps the optimizer from putting the functions in at each use."""
    s, t, read = F.col(source), F.col(translation), T.as_ascii if ascii_words else str
    facts = {
        "source_letters": T.letter_count(s, read), "translation_letters": T.letter_count(t, read),
        "source_norm": T.norm_text(s, read), "translation_norm": T.norm_text(t, read),
        "technical": T.technical_reason(s, ascii_words), "signal": T.has_english_signal(s, read),
        "source_markers": T.markers(s, read), "translation_markers": T.markers(t, read),
        "entities_leaked": F.array_except(T.entities(t), T.entities(s)),
        "residue": F.size(T.tokens_in(t, T.RESIDUE_WORDS, read)),
    }
    kept = [c for c in pairs.columns if c not in facts]
    return pairs.select(*kept, F.inline(F.array(F.struct(*(f.alias(name) for name, f in facts.items())))))


def issue(severity: str, code: str) -> Column:
    return F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"))


def check_pairs(pairs: DataFrame, title_allowed: bool = False, min_letters: int = MIN_UNCHANGED_LETTERS, ascii_words: bool = False) -> DataFrame:
    """Pairs with `issues` (array<struct<severity, code>>) in the order of the checks, and `suppressed` (why an unchanged pair is fine).

    An empty translation ends a pair's checks, as do a suppressed and an unchanged one; the other checks all run.
    ascii_words: see technical_reason.
    """
    facts = with_facts(pairs, ascii_words=ascii_words)
    s, t, read = F.col("source"), F.col("translation"), T.as_ascii if ascii_words else str
    same = (F.col("source_norm") == F.col("translation_norm")) & (F.col("source_norm") != "")
    empty = ~T.is_blank(s, read) & T.is_blank(t, read)
    suppressed = F.when(~empty & same & (F.col("technical") != ""), F.col("technical"))
    if title_allowed:
        suppressed = F.coalesce(suppressed, F.when(~empty & (F.col("source_norm") == F.col("translation_norm")) & T.is_title_like(s), "title_like_value"))
    unchanged = (F.col("source_letters") >= min_letters) & F.col("signal") & (F.col("source_norm") == F.col("translation_norm"))
    short = (F.col("source_letters") <= HEURISTIC_LETTERS) & (F.col("translation_letters") <= HEURISTIC_LETTERS * RATIO_HIGH)
    ratio = F.col("translation_letters") / F.greatest(F.col("source_letters"), F.lit(1))
    rated = (F.col("source_letters") >= RATIO_LETTERS) & (F.col("translation_letters") > 0) & (F.col("technical") == "")
    later = [
        (F.size("entities_leaked") > 0, "html_entity_leak"),
        (short & (F.size("source_markers") > 0) & (F.col("source_markers") != F.col("translation_markers")), "placeholder_or_marker_changed"),
        (rated & (ratio < RATIO_LOW), "length_ratio_low"),
        (rated & (ratio > RATIO_HIGH), "length_ratio_high"),
        (~T.is_blank(t, read) & (F.col("source_norm") != F.col("translation_norm")) & short & (F.col("translation_letters") >= RATIO_LETTERS) & (F.col("residue") >= RESIDUE_TOKENS) & (F.col("technical") == ""), "english_residue"),
    ]
    none = F.array().cast("array<struct<severity:string,code:string>>")
    found = none if title_allowed else F.filter(F.array(*(F.when(rule, issue("warning", code)) for rule, code in later)), lambda x: x.isNotNull())
    issues = F.when(empty, F.array(issue("error", "empty_translation"))).when(F.col("suppressed").isNotNull(), none).when(unchanged, F.array(issue("warning", "unchanged_translation"))).otherwise(found)
    return facts.withColumn("suppressed", suppressed).withColumn("issues", issues)


def issues_of(checked: DataFrame, keys: list[str]) -> DataFrame:
    """One row per issue.

    The outer explode keeps the optimizer from testing the list below it, which would compute all checks twice.
    """
    each = checked.select(*keys, "source", "translation", F.posexplode_outer("issues").alias("check_ord", "issue")).where("check_ord is not null")
    return each.select(*keys, "check_ord", "issue.severity", "issue.code", T.truncated(F.col("source")).alias("source"), T.truncated(F.col("translation")).alias("translation"))


def diagnostics(facts: DataFrame) -> DataFrame:
    """Pairs with what was measured of them as one struct."""
    ratio = T.length_ratio(F.col("source_letters"), F.col("translation_letters"))
    return facts.withColumn("diagnostics", F.struct(
        "source_letters", "translation_letters", ratio.alias("length_ratio"), (F.col("source_norm") == F.col("translation_norm")).alias("same_text"), "technical", F.col("signal").alias("english_signal"),
        "source_markers", "translation_markers", "entities_leaked", "residue", F.char_length("source").alias("source_chars"),
    ))


def action_changes(pairs: DataFrame) -> DataFrame:
    """Pairs whose sequence of actions changed."""
    return pairs.where(T.action_sequence(F.col("source")) != T.action_sequence(F.col("translation")))


def repeated_translations(facts: DataFrame, least: int = REPEAT_SOURCES) -> DataFrame:
    """Translations that stand for at least so many distinct sources in a field. One grouping; counts are partial."""
    fits = facts.where((F.char_length("source") <= REPEAT_CHARS) & (F.char_length("translation") <= REPEAT_CHARS) & (F.col("source_letters") >= RATIO_LETTERS) & (F.col("translation_letters") >= RATIO_LETTERS) & (F.col("source_norm") != F.col("translation_norm")) & (F.col("technical") == "") & (F.col("translation_norm") != ""))
    order = F.struct("row_idx", "pair_ord")
    each = fits.groupBy(T.root_field(F.col("field")).alias("root"), "translation_norm", "source_norm").agg(F.count("*").alias("n"), F.min(order).alias("at"), F.min_by(F.substring("source", 1, 180), order).alias("example"), F.min_by("translation", order).alias("translation"))
    keys = ["root", "translation_norm"]
    groups = each.groupBy(*keys).agg(F.count("*").alias("distinct_sources"), F.sum("n").alias("occurrences"), F.min("at").alias("first"), F.min_by("translation", "at").alias("translation"))
    # the first few sources of each: ranks are cut off before and after the shuffle, so no group is gathered whole
    few = each.withColumn("k", F.row_number().over(Window.partitionBy(*keys).orderBy("at"))).where(F.col("k") <= REPEAT_EXAMPLES)
    examples = few.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "example"))), lambda x: x["example"]).alias("examples"))
    found = groups.where(F.col("distinct_sources") >= least).join(examples, keys)
    return found.select(*keys, "distinct_sources", "occurrences", F.col("first.row_idx").alias("row_idx"), "translation", "examples")


def split_issues(source: DataFrame, target: DataFrame, extra_allowed: tuple[str, ...] = ()) -> DataFrame:
    """Missing and extra splits, and differing row counts."""
    a = source.groupBy("split").agg(F.count("*").alias("source_rows"))
    b = target.groupBy("split").agg(F.count("*").alias("translation_rows"))
    code = F.when(F.col("translation_rows").isNull(), "split_missing").when(F.col("source_rows").isNull() & ~F.col("split").isin(list(extra_allowed)), "split_extra").when(F.col("source_rows") != F.col("translation_rows"), "row_count_mismatch")
    both = a.join(b, "split", "full_outer").withColumn("code", code).where("code is not null")
    return both.select("split", "code", F.when(F.col("code") == "split_extra", "warning").otherwise("error").alias("severity"), "source_rows", "translation_rows")


def missing_fields(source_columns: list[str], target_columns: list[str], rules) -> list[tuple[str, str]]:
    """(side, column) of what the rules need and the schemas lack; no job is run."""
    return [("source", r.source) if r.source not in source_columns else ("translation", r.target) for r in rules if r.source not in source_columns or r.target not in target_columns]
