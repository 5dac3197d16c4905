"""Suggestions for issues that one request each can fix."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scoring as S
from ..functions import text as T
from .judge import judged, with_prompt
from .metrics import FIRST, first_place

# Codes that a better translation can fix.
FIXABLE = ["unchanged_translation", "english_residue", "html_entity_leak", "placeholder_or_marker_changed", "empty_translation"]
TEMPLATE = 'Translate from {source_lang} to {target_lang} ({domain}). A check found {code}: {message}\nSource:\n{source}\nTranslation:\n{translation}\nAnswer with JSON: {"suggested_translation": "...", "confidence": 0.0, "rationale": "..."}'


def cases(issues: DataFrame, most: int = -1, ascii_words: bool = False) -> DataFrame:
    """Issues that say the same of the same texts (up to white space) as one case, the first one's, with their number. metrics.issue_locations has all places.

    issues: severity, code, split, row_idx, field, source, translation, and, if there are any, message, duplicate_count. A
    duplicate counts as often as it stands for. With a limit, the first cases in row order. ascii_words: see technical_reason.
    """
    defaults, read = {"message": F.lit(""), "duplicate_count": F.lit(1)}, T.as_ascii if ascii_words else str
    rows = issues.withColumns({k: v for k, v in defaults.items() if k not in issues.columns})
    rows = rows.where(F.col("code").isin(FIXABLE) & (T.squeeze(F.coalesce("source", F.lit("")), read) != "") & (T.squeeze(F.coalesce("translation", F.lit("")), read) != ""))
    found = rows.groupBy("code", F.coalesce("message", F.lit("")).alias("message"), T.squeeze(F.col("source"), read).alias("source"), T.squeeze(F.col("translation"), read).alias("translation")).agg(
        F.sum(F.greatest(F.lit(1), F.coalesce("duplicate_count", F.lit(1)))).cast("long").alias("occurrences"), first_place().alias("first"),
    )
    found = found.select("code", "message", "source", "translation", "occurrences", *FIRST)
    return found if most < 0 else found.orderBy(F.asc_nulls_last("split"), "row_idx", F.asc_nulls_last("field"), "code", "message").limit(most)


def suggestions(found: DataFrame, judge: str, source_lang: str, target_lang: str, domain: str = "general", template: str = TEMPLATE, **policy) -> DataFrame:
    """A row for each case: suggestion_id, status (ok, error, parse_error), suggestion, confidence, rationale."""
    rows = found.withColumns({"source_lang": F.lit(source_lang), "target_lang": F.lit(target_lang), "domain": F.lit(domain)})
    names = {k: k for k in ("source_lang", "target_lang", "domain", "code", "message", "source", "translation")}
    done = judged(with_prompt(rows, template, names), judge, **policy)
    done = done.withColumn("said", S.parsed_suggestion(F.col("reply")))
    failed = F.col("error") != ""
    return done.select(
        F.concat_ws(":", "split", F.col("row_idx").cast("string"), "field", "code").alias("suggestion_id"), "split", "row_idx", "field", "code", "message", "source", "translation", "occurrences",
        F.when(failed, "error").otherwise(F.col("said.status")).alias("status"), F.when(failed, "").otherwise(F.col("said.suggestion")).alias("suggestion"), F.when(~failed, F.col("said.confidence")).alias("confidence"),
        F.when(failed, "").otherwise(F.col("said.rationale")).alias("rationale"), "error",
    )


def summary(done: DataFrame) -> dict:
    """Numbers by status, and how many issues the suggestions stand for."""
    rows = done.groupBy("status").agg(F.count("*").alias("n"), F.sum("occurrences").alias("occurrences")).collect()
    return {"cases": sum(r.n for r in rows), "occurrences": sum(r.occurrences for r in rows), "statuses": {r.status: r.n for r in sorted(rows, key=lambda r: r.status)}}


def text_summary(found: dict) -> str:
    return f"{found['cases']} cases for {found['occurrences']} issues: " + json.dumps(found["statuses"], ensure_ascii=False)
