"""Counts, rates and guidance over issues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# What to do about each code.
GUIDE = {
    "row_count_mismatch": ("Row count mismatch", "fix"), "split_missing": ("Missing split", "fix"), "schema_missing_field": ("Missing field", "fix"), "list_length_mismatch": ("List length mismatch", "fix"),
    "field_type_mismatch": ("Field type mismatch", "fix"), "empty_translation": ("Empty field", "fix"), "weblinx_action_changed": ("WebLINX action changed", "fix"), "unchanged_translation": ("Unchanged English text", "review"),
    "english_residue": ("English residue", "review"), "placeholder_or_marker_changed": ("Placeholder changed", "review"), "html_entity_leak": ("HTML entity leak", "review"), "length_ratio_low": ("Translation too short", "sample"),
    "length_ratio_high": ("Translation too long", "sample"), "repeated_translation": ("Repeated translation", "sample"), "split_extra": ("Extra split", "sample"),
}
PRIORITIES = {"fix": 0, "review": 1, "sample": 2}
# What a priority is called; one code has a name of its own.
LABELS = {"fix": "Fix before upload", "review": "Review", "sample": "Sample audit"}
OWN_LABELS = {"split_extra": "Check config"}
#: What each code says of the data, and what helps.
ADVICE = {
    "row_count_mismatch": ("A split has other numbers of rows on its two sides.", "Make the translated split again; rows no longer stand beside their sources."),
    "split_missing": ("The translation lacks a split of the source.", "Look at the configured splits and at the export."),
    "schema_missing_field": ("A column that a rule names is not there.", "Correct the rule, or write the column."),
    "list_length_mismatch": ("A list has lost or won items.", "Mend the row; its turns no longer stand beside their sources."),
    "field_type_mismatch": ("The two values are of different shapes.", "Mend the row, or choose another strategy."),
    "empty_translation": ("A text became empty.", "Translate it again."),
    "weblinx_action_changed": ("Actions in a log were changed.", "Put the actions back as they were; only words are to change."),
    "unchanged_translation": ("An English text is still the same.", "Translate it, unless it is a name, a title, an address or code."),
    "english_residue": ("Several English words are left.", "Look at the examples; parts may not be translated."),
    "placeholder_or_marker_changed": ("A bracketed marker or tag is not what it was.", "Put it back if something reads it."),
    "html_entity_leak": ("An HTML entity came in.", "Decode it where readers see it."),
    "length_ratio_low": ("Much shorter than its source.", "Look for texts that were cut off."),
    "length_ratio_high": ("Much longer than its source.", "Look for texts that were repeated or made up."),
    "repeated_translation": ("One translation stands for several sources.", "Look at the groups; short answers may rightly be the same."),
    "split_extra": ("The translation has a split of its own.", "Say in the configuration that it is meant."),
}


def issue_counts(issues: DataFrame) -> DataFrame:
    """Counts by severity, by code and by normal field in one pass."""
    rows = issues.withColumn("normal_field", T.normal_field(F.col("field")))
    counted = rows.groupingSets([["severity"], ["code"], ["normal_field"]], "severity", "code", "normal_field").agg(F.count("*").alias("n"), F.grouping("severity").alias("g1"), F.grouping("code").alias("g2"))
    kind = F.when(F.col("g1") == 0, "severity").when(F.col("g2") == 0, "code").otherwise("field")
    return counted.select(kind.alias("kind"), F.coalesce("severity", "code", "normal_field").alias("key"), "n")


def pairs_and_issues(checked: DataFrame, more: DataFrame | None, *keys: str) -> DataFrame:
    """keys, code, severity, pair (1 at one row of each pair, 0 elsewhere): pairs and their issues in one pass.

    more: issues that are not of one pair, or all of them if the pairs have no column of issues.
    """
    if "issues" in checked.columns:
        rows = checked.select(*keys, F.posexplode_outer("issues").alias("i", "issue"))
        rows = rows.select(*keys, "issue.code", "issue.severity", F.when(F.coalesce("i", F.lit(0)) == 0, 1).otherwise(0).alias("pair"))
    else:
        none = F.lit(None).cast("string")
        rows = checked.select(*keys, none.alias("code"), none.alias("severity"), F.lit(1).alias("pair"))
    return rows if more is None else rows.unionByName(more.select(*keys, "code", "severity", F.lit(0).alias("pair")))


def group_metrics(checked: DataFrame, key: str, more: DataFrame | None = None, top: int = 3) -> DataFrame:
    """Checked pairs, issues, rates and top codes by a column; a key with nothing checked and no issue has no row. Checks are computed once."""
    by_code = pairs_and_issues(checked, more, key).groupBy(key, "code").agg(F.sum("pair").alias("pairs"), F.count("code").alias("n"), F.count_if(F.col("severity") == "error").alias("errors"))
    best = F.slice(F.array_sort(F.collect_list(F.when(F.col("code").isNotNull(), F.struct((-F.col("n")).alias("o"), "code", "n")))), 1, top)
    said = F.array_join(F.transform(best, lambda c: F.concat(c["code"], F.lit(":"), c["n"].cast("string"))), ",")
    both = by_code.groupBy(key).agg(F.sum("pairs").alias("checked_pairs"), F.sum("n").alias("issues"), F.sum("errors").alias("errors"), said.alias("top_codes"))
    rate = lambda c: T.rounded(F.try_divide(c, F.col("checked_pairs")), 6)
    warnings = F.col("issues") - F.col("errors")
    return both.select(key, "checked_pairs", "issues", "errors", warnings.alias("warnings"), rate(F.col("issues")).alias("issue_rate"), rate(F.col("errors")).alias("error_rate"), rate(warnings).alias("warning_rate"), "top_codes")


def issue_guide(issues: DataFrame) -> DataFrame:
    """Counts by code with their guidance; an unknown code is to be sampled."""
    guide = issues.sparkSession.createDataFrame([(c, r, p, OWN_LABELS.get(c, LABELS[p]), *ADVICE[c]) for c, (r, p) in GUIDE.items()], "code string, rule string, priority string, label string, meaning string, action string")
    counted = issues.groupBy("code").agg(F.count("*").alias("n")).join(F.broadcast(guide), "code", "left")
    named = F.coalesce("rule", F.initcap(F.replace("code", F.lit("_"), F.lit(" "))))
    return counted.select("code", "n", named.alias("rule"), F.coalesce("priority", F.lit("sample")).alias("priority"), F.coalesce("label", F.lit(LABELS["sample"])).alias("label"), F.coalesce("meaning", F.lit("")).alias("meaning"), F.coalesce("action", F.lit("Look at the examples.")).alias("action"))


def checked_counts(checked: DataFrame) -> DataFrame:
    """Checked rows and pairs, overall, by split, and pairs by exact field, in one pass: kind, key, rows, pairs."""
    # a row is counted at its first pair
    first = F.count_distinct(F.struct("split", "row_idx"))
    found = checked.groupingSets([[], ["split"], ["field"]], "split", "field").agg(F.count("*").alias("pairs"), first.alias("rows"), F.grouping("split").alias("g1"), F.grouping("field").alias("g2"))
    kind = F.when(F.col("g1") == 0, "split").when(F.col("g2") == 0, "field").otherwise("all")
    return found.select(kind.alias("kind"), F.coalesce("split", "field", F.lit("")).alias("key"), "rows", "pairs")


def issue_counters(issues: DataFrame) -> DataFrame:
    """Counts by severity, code, split, normal field and root field, each with its place by (count, key): kind, key, n, place."""
    rows = issues.select("severity", "code", "split", T.normal_field(F.col("field")).alias("field"), T.root_field(F.col("field")).alias("root"))
    names = ["severity", "code", "split", "field", "root"]
    counted = rows.groupingSets([[c] for c in names], *names).agg(F.count("*").alias("n"), *(F.grouping(c).alias(f"g_{c}") for c in names))
    kind = F.lit("")
    for c in names:
        kind = F.when(F.col(f"g_{c}") == 0, c).otherwise(kind)
    kept = counted.select(kind.alias("kind"), F.coalesce(*names).alias("key"), "n")
    return kept.withColumn("place", F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("n"), "key")))


def field_rows(checked: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """group_metrics by normal field, with its exact fields and the positions of its issues."""
    with_normal = checked.withColumn("normal_field", T.normal_field(F.col("field")))
    rest = None if more is None else more.withColumn("normal_field", T.normal_field(F.col("field")))
    found = group_metrics(with_normal, "normal_field", rest)
    exact = with_normal.select("normal_field", "field") if rest is None else with_normal.select("normal_field", "field").unionByName(rest.select("normal_field", "field"))
    fields = exact.groupBy("normal_field").agg(F.count_distinct("field").alias("exact_fields"))
    issued = with_normal.where("size(issues) > 0").select("field")
    at = position_summary(issued if rest is None else issued.unionByName(rest.select("field"))).withColumnRenamed("field", "normal_field")
    return found.join(fields, "normal_field", "left").join(at, "normal_field", "left").withColumn("positions", F.coalesce("positions", F.lit("")))


def split_rows(checked: DataFrame, sizes: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """group_metrics by split, with the declared size and the checked rows; splits with nothing checked and no issue are left out."""
    rows = checked.groupBy("split").agg(F.count_distinct("row_idx").alias("checked_rows"))
    found = group_metrics(checked, "split", more).join(rows, "split", "left").join(sizes.select("split", F.col("rows").alias("declared_rows")), "split", "full_outer")
    found = found.fillna(0, ["checked_pairs", "issues", "errors", "warnings", "checked_rows"]).fillna("", ["top_codes"])
    return found.where("checked_rows > 0 or checked_pairs > 0 or issues > 0")


RECORD = ["severity", "code", "message", "source", "translation"]


def as_records(issues: DataFrame, ascii_words: bool = False) -> DataFrame:
    """Issues with what makes them one record (white space in texts does not count) and its id. ascii_words: see technical_reason."""
    defaults = {"message": F.lit(""), "duplicate_count": F.lit(1), "occurrence_count": F.lit(1)}
    rows = issues.withColumns({k: v for k, v in defaults.items() if k not in issues.columns})
    text = lambda c: T.squeeze(F.coalesce(c, F.lit("")), T.as_ascii if ascii_words else str)
    rows = rows.withColumns({"message": F.coalesce("message", F.lit("")), "source": text("source"), "translation": text("translation")})
    return rows.withColumn("record_id", F.sha2(F.to_json(F.struct(*RECORD)), 256))


FIRST = ["first.split", "first.row_idx", "first.field"]


def first_place() -> Column:
    """The least place of a group; nulls come last, as in SQL engines."""
    return F.min(F.struct(F.col("split").isNull().alias("no_split"), "split", "row_idx", F.col("field").isNull().alias("no_field"), "field"))


def issue_records(issues: DataFrame, ascii_words: bool = False) -> DataFrame:
    """Issues of one severity, code and message about the same texts as one record, with the place of the first, its fields and its splits.

    occurrences: each issue counts as often as it stands for. Places are a table of their own (issue_locations), as there can be any number.
    """
    n = F.greatest(F.lit(1), F.coalesce("duplicate_count", F.lit(1)), F.coalesce("occurrence_count", F.lit(1))).cast("long")
    distinct = lambda c: F.array_sort(F.collect_set(c))
    found = as_records(issues, ascii_words).groupBy("record_id", *RECORD).agg(F.sum(n).alias("occurrences"), first_place().alias("first"), distinct(T.normal_field(F.col("field"))).alias("fields"), distinct("split").alias("splits"))
    return found.select("record_id", *RECORD, "occurrences", *FIRST, "fields", "splits")


def issue_locations(issues: DataFrame) -> DataFrame:
    """Where the issues of every record are."""
    return as_records(issues).select("record_id", "split", "row_idx", F.col("field").alias("exact_field"), T.normal_field(F.col("field")).alias("field"), position_note(F.col("field")).alias("position"))


def position_note(field: Column) -> Column:
    """The indices of one field in words: `turn 2 / turn 1`; empty without any."""
    at = F.transform(F.regexp_extract_all(field, F.lit(r"\[(\d+)\]"), F.lit(1)), lambda x: F.concat(position_kind(field), F.lit(" "), (x.try_cast("int") + 1).cast("string")))
    return F.array_join(at, " / ")


def position_kind(field: Column) -> Column:
    return F.when(field.contains(".content") | F.lower(field).rlike("dialog|turn"), "turn").otherwise("item")


def filtered_records(records: DataFrame, severity: str = "", code: str = "", split: str = "", field: str = "", search: str = "") -> DataFrame:
    """Records of a severity, code, split and field, where given, that have a text somewhere."""
    keep = F.lit(True)
    for column, value in (("severity", severity), ("code", code)):
        keep = keep & (F.col(column) == value) if value else keep
    if split:
        keep = keep & F.array_contains("splits", split)
    if field:
        keep = keep & F.array_contains("fields", field)
    if search:
        said = F.lower(F.concat_ws(" ", "severity", "code", "message", "source", "translation", F.array_join("fields", " "), F.array_join("splits", " ")))
        keep = keep & said.contains(search.lower())
    return records.where(keep)


def page(records: DataFrame, number: int, size: int = 50) -> DataFrame:
    """One page of records: errors first, then by how much they stand for."""
    order = [F.when(F.col("severity") == "error", 0).otherwise(1), F.desc("occurrences"), "code", F.asc_nulls_last("split"), "row_idx", F.asc_nulls_last("field"), "source"]
    return records.orderBy(*order).offset(number * size).limit(size)


def verdict(checked: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """One row: totals, verdict and recommendation, in one pass."""
    counts = pairs_and_issues(checked, more).agg(F.coalesce(F.sum("pair"), F.lit(0)).alias("checked_pairs"), F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    share = F.col("warnings") / F.greatest(F.col("checked_pairs"), F.lit(1))
    return counts.select(
        "checked_pairs", "errors", "warnings",
        F.when(F.col("errors") > 0, "fail").when(F.col("warnings") > 0, "pass_with_warnings").otherwise("pass").alias("verdict"),
        F.when(F.col("errors") > 0, "block").when(F.col("warnings") == 0, "pass").when(share < 0.001, "sample").otherwise("review").alias("recommendation"),
    )


def position_summary(issues: DataFrame) -> DataFrame:
    """By normal field the distinct positions its issues are at, as words."""
    every = F.transform(F.regexp_extract_all("field", F.lit(r"\[(\d+)\]"), F.lit(1)), lambda x: x.try_cast("int") + 1)
    at = issues.withColumn("position", F.explode_outer(every))
    kind = position_kind(F.col("normal"))
    p = F.array_sort(F.collect_set("position"))
    found = at.groupBy(T.normal_field(F.col("field")).alias("normal")).agg(p.alias("p"))
    n, first, last = F.size("p"), F.array_min("p"), F.array_max("p")
    said = F.when(n == 0, "").when(n == 1, F.concat(kind, F.lit(" "), first.cast("string"))).when(last - first + 1 == n, F.concat(kind, F.lit("s "), first.cast("string"), F.lit("-"), last.cast("string"))).when(n <= 4, F.concat(kind, F.lit("s "), F.array_join(F.col("p").cast("array<string>"), ", "))).otherwise(F.concat(n.cast("string"), F.lit(" "), kind, F.lit(" positions")))
    return found.select(F.col("normal").alias("field"), said.alias("positions"))


def deduplicated(issues: DataFrame, order: list[str]) -> DataFrame:
    """Warnings that say the same of the same texts once, the first, with their number; all else passes through."""
    can = F.coalesce((F.col("severity") == "warning") & F.col("source").isNotNull() & F.col("translation").isNotNull(), F.lit(False))
    texts = [c for c in ("code", "field", "message", "source", "translation") if c in issues.columns]
    # what passes through is a group of its own: by all that it has
    own = F.when(~can, F.struct(*(c for c in issues.columns if c not in texts)))
    rest = [c for c in issues.columns if c not in texts]
    kept = issues.groupBy(*texts, own.alias("own")).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("first"), F.count("*").alias("n"))
    each = kept.withColumn("copy", F.explode(F.when(F.col("own").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(1).cast("long"), "n"))))
    found = each.select(*texts, "first.*", F.when(F.col("own").isNull(), F.col("n")).otherwise(1).alias("duplicate_count"))
    return found.select(*issues.columns, "duplicate_count")


def fix_cases(issues: DataFrame, ascii_words: bool = False) -> DataFrame:
    """Issues worth one request each: same code, source up to white space, and translation."""
    fixable = ["unchanged_translation", "english_residue", "html_entity_leak", "placeholder_or_marker_changed", "empty_translation"]
    read = T.as_ascii if ascii_words else str
    rows = issues.where(F.col("code").isin(fixable) & (T.squeeze(F.col("source"), read) != "") & ~T.is_blank(F.col("translation"), read))
    return rows.groupBy("code", T.squeeze(F.col("source"), read).alias("source"), "translation").agg(F.count("*").alias("occurrences"), F.min("row_idx").alias("first_row"))
