"""Scores, languages and usage values as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import first_json_object, let

# Language codes and names.
LANGUAGES = {
    "ar": "Arabic", "cs": "Czech", "de": "German", "en": "English", "es": "Spanish", "et": "Estonian", "fi": "Finnish", "fr": "French", "hr": "Croatian", "ja": "Japanese", "ko": "Korean",
    "liv": "Livonian", "lv": "Latvian", "ne": "Nepali", "pt": "Portuguese", "ro": "Romanian", "ru": "Russian", "sah": "Sakha", "si": "Sinhala", "tr": "Turkish", "uk": "Ukrainian", "zh": "Chinese",
}


def lookup(c: Column, table: dict[str, str], default: Column) -> Column:
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), default)


def language_name(c: Column) -> Column:
    return lookup(F.lower(F.trim(c)), LANGUAGES, F.trim(c))


def language_code(c: Column) -> Column:
    lower = F.lower(F.trim(c))
    return F.when(lower.isin(list(LANGUAGES)), lower).otherwise(lookup(lower, {v.lower(): k for k, v in LANGUAGES.items()}, lower))


def language_pair(c: Column) -> Column:
    """The last part of a path, with hyphens for underscores."""
    return F.replace(F.substring_index(c, "/", -1), F.lit("_"), F.lit("-"))


def normalised_score(c: Column, low: float, high: float, higher_is_better: bool = True, scale: float = 1.0) -> Column:
    if low == high:
        raise ValueError("equal bounds")
    share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (c - low) / (high - low)))
    return (share if higher_is_better else 1 - share) * scale


def score_bin(c: Column, thresholds: list[float], labels: list[str] | None = None) -> Column:
    """The first bin whose threshold is strictly greater; null stays null."""
    names = labels or [f"bin_{i}" for i in range(len(thresholds) + 1)]
    if len(names) != len(thresholds) + 1:
        raise ValueError("one label more than thresholds")
    out = F.lit(names[-1])
    for t, name in reversed(list(zip(thresholds, names, strict=False))):
        out = F.when(c < t, name).otherwise(out)
    return F.when(c.isNotNull(), out)


def clamped(c: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.when(c.isNotNull(), F.least(F.lit(high), F.greatest(F.lit(low), c)))


def parsed_score(reply: Column) -> Column:
    """struct<score, comment, parse_status> of a judge's reply: a JSON object's score, else a number after the word score."""
    def of(body: Column) -> Column:
        given = F.try_variant_get(body, "$.score", "variant")
        number = F.schema_of_variant(given).rlike("^(?:BIGINT|DECIMAL|DOUBLE|FLOAT)")
        by_text = F.regexp_extract(reply, r"(?i)score[\"\s:]+(-?\d+(?:\.\d+)?)", 1)
        score = F.when(number, F.try_variant_get(body, "$.score", "double")).when(by_text != "", by_text.try_cast("double"))
        found = F.coalesce(number, F.lit(False))
        return F.struct(
            clamped(score).alias("score"),
            F.when(found, F.coalesce(F.try_variant_get(body, "$.comment", "string"), F.lit(""))).otherwise(F.substring(F.coalesce(reply, F.lit("")), 1, 200)).alias("comment"),
            F.when(found | F.coalesce(by_text != "", F.lit(False)), "ok").otherwise("parse_error").alias("parse_status"),
        )

    return let(first_json_object(reply), of)


def parsed_suggestion(reply: Column) -> Column:
    """struct<suggestion, confidence, rationale, status> of a reply that proposes a better translation."""

    def of(body: Column) -> Column:
        text = lambda key: F.trim(F.coalesce(F.try_variant_get(body, f"$.{key}", "string"), F.lit("")))
        number = F.schema_of_variant(F.try_variant_get(body, "$.confidence", "variant")).rlike("^(?:BIGINT|DECIMAL|DOUBLE|FLOAT)")
        confidence = clamped(F.when(number, F.try_variant_get(body, "$.confidence", "double")), 0.0, 1.0)
        said = text("suggested_translation")
        return F.struct(said.alias("suggestion"), confidence.alias("confidence"), text("rationale").alias("rationale"), F.when(said != "", "ok").otherwise("parse_error").alias("status"))

    return let(first_json_object(reply), of)


def reported_cost(response: Column) -> Column:
    """The first number among the places where services put the cost of a call (a variant)."""
    numeric = lambda path: F.when(F.schema_of_variant(F.try_variant_get(response, path, "variant")).rlike("^(?:BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(response, path, "double"))
    return F.coalesce(*(numeric(p) for p in ("$.cost", "$.total_cost", "$.usage.cost", "$.usage.total_cost", "$.usage.estimated_cost")))


def reported_tokens(response: Column) -> Column:
    """struct<prompt_tokens, completion_tokens, total_tokens> as whole numbers; a missing total is the sum of the others."""
    count = lambda key: F.try_variant_get(response, f"$.usage.{key}", "long")
    prompt, completion = count("prompt_tokens"), count("completion_tokens")
    return F.struct(prompt.alias("prompt_tokens"), completion.alias("completion_tokens"), total_tokens(prompt, completion, count("total_tokens")).alias("total_tokens"))


def total_tokens(prompt: Column, completion: Column, total: Column) -> Column:
    return F.coalesce(total, prompt + completion)
