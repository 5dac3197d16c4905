"""Alignment of an external dialogue corpus with source rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip_prefix
from ..sources.objects import read_object


def candidate_dialogues(spark, path: str) -> DataFrame:
    """A JSON object id -> {log: [{text}]} as rows of dialogue_id, turns; of an id that is there twice the last one. The object is read in parts (see read_object)."""
    rows = read_object(spark, path).groupBy(F.col("key").alias("dialogue_id")).agg(F.max_by("value", "place").alias("value"))
    return rows.select("dialogue_id", F.transform(F.from_json("value", "struct<log:array<struct<text:string>>>")["log"], lambda t: t["text"]).alias("turns"))


def dialogue_turns(conversations: DataFrame) -> DataFrame:
    """Dialogues as ordered lists: dialogue_id, turns."""
    row = F.struct("turn", "text")
    return conversations.groupBy(F.col("conv_id").alias("dialogue_id")).agg(F.transform(F.sort_array(F.collect_list(row)), lambda t: t["text"]).alias("turns"))


def reformatted(source: DataFrame, external: DataFrame, turns_per_row: int = 2, offset: int = 0, roles: tuple[str, ...] = ("user", "assistant"), missing: str = "skip_dialogues", prefixes: tuple[str, ...] = (), variant: str = "external") -> DataFrame:
    """Source rows (split, row_idx, dialogue_id, text, history) with text and history of the external dialogue, old ones kept.

    Row k of a dialogue has turn k * turns_per_row + offset; its history is all before it. Dialogues without enough turns
    for exactly their rows, or that are missing, are skipped or kept as they are.
    """
    by_dialogue = Window.partitionBy("split", "dialogue_id")
    rows = source.withColumn("dialogue_id", strip_prefix(F.col("dialogue_id"), list(prefixes))).withColumn("k", F.row_number().over(by_dialogue.orderBy("row_idx")) - 1).withColumn("rows", F.count("*").over(by_dialogue))
    both = rows.join(external, "dialogue_id", "left")
    fits = F.coalesce(F.size("turns") == F.col("rows") * turns_per_row, F.lit(False))
    at = F.col("k") * turns_per_row + offset
    cycle = F.array(*(F.lit(r) for r in roles))
    history = F.transform(F.slice("turns", F.lit(1), at), lambda t, i: F.struct(cycle[F.pmod(i, F.lit(len(roles)))].alias("role"), t.alias("content")))
    out = both.withColumns({"source_text": F.col("text"), "source_history": F.col("history"), "reformat_variant": F.lit(variant), "fits": fits})
    out = out.withColumns({"text": F.when(F.col("fits"), F.try_element_at("turns", (at + 1).cast("int"))).otherwise(F.col("text")), "history": F.when(F.col("fits"), history).otherwise(F.col("history"))})
    if missing != "keep_source":
        out = out.where("fits")
    return out.drop("k", "rows", "turns", "fits")


def reformat_summary(source: DataFrame, external: DataFrame, output: DataFrame, turns_per_row: int = 2, samples: tuple[int, int] = (20, 5)) -> DataFrame:
    """By split: source and output rows, dialogues the external corpus lacks and those with other numbers of turns, and the first ids of both."""
    per = source.groupBy("split", "dialogue_id").agg(F.count("*").alias("rows"))
    both = per.join(external.select("dialogue_id", F.size("turns").alias("turns")), "dialogue_id", "left")
    marked = both.withColumns({"missing": F.col("turns").isNull(), "bad": F.coalesce(F.col("turns") != F.col("rows") * turns_per_row, F.lit(False))})
    # only the first ids of each kind are gathered
    first = lambda kind, most: marked.where(kind).withColumn("k", F.row_number().over(Window.partitionBy("split").orderBy("dialogue_id"))).where(F.col("k") <= most).groupBy("split").agg(F.array_sort(F.collect_list("dialogue_id")).alias(f"{kind}_ids"))
    totals = marked.groupBy("split").agg(F.sum("rows").alias("source_rows"), F.count_if("missing").alias("missing"), F.count_if("bad").alias("bad"))
    written = output.groupBy("split").agg(F.count("*").alias("output_rows"))
    found = totals.join(written, "split", "left").join(first("missing", samples[0]), "split", "left").join(first("bad", samples[1]), "split", "left")
    return found.fillna(0, ["output_rows"])


def coverage_report(source: DataFrame, external: DataFrame, turns_per_row: int = 2) -> dict:
    """What a candidate corpus has of the source's dialogues: numbers on both sides and in common, the first ids of each difference, alignments, a first text."""
    ids, there = source.select("dialogue_id").distinct(), external.select("dialogue_id").distinct()
    some = lambda df: [r.dialogue_id for r in df.orderBy("dialogue_id").limit(20).collect()]
    only_source, only_external = ids.join(there, "dialogue_id", "left_anti"), there.join(ids, "dialogue_id", "left_anti")
    return {
        "source_dialogues": ids.count(), "external_dialogues": there.count(), "common": ids.join(there, "dialogue_id", "left_semi").count(), "source_only": only_source.count(), "external_only": only_external.count(),
        "source_only_ids": some(only_source), "external_only_ids": some(only_external), "coverage": [r.asDict() for r in coverage(source, external).orderBy("split").collect()],
        "rows_per_dialogue": {r["rows"]: r.n for r in source.groupBy("dialogue_id").agg(F.count("*").alias("rows")).groupBy("rows").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "rows").limit(20).collect()},
        "alignment": [r.asDict() for r in turn_alignment(source, external, turns_per_row).collect()],
        "first_text": (external.where("size(turns) > 0").orderBy("dialogue_id").select(F.get("turns", F.lit(0)).alias("t")).limit(1).collect() or [{"t": ""}])[0]["t"],
    }


def history_prefixes(conversations: DataFrame) -> DataFrame:
    """Every turn with the number and characters of those before it."""
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    return conversations.select("conv_id", "turn", F.count("*").over(before).alias("turns_before"), F.coalesce(F.sum(F.char_length("text")).over(before), F.lit(0)).alias("chars_before"))


def coverage(source: DataFrame, external: DataFrame) -> DataFrame:
    """By split the dialogues that the external corpus has and lacks."""
    ids = source.select("split", "dialogue_id").distinct().join(external.select("dialogue_id", F.lit(True).alias("there")).distinct(), "dialogue_id", "left")
    return ids.groupBy("split").agg(F.count_if("there").alias("covered"), F.count_if(F.col("there").isNull()).alias("missing"))


def turn_alignment(source: DataFrame, external: DataFrame, turns_per_row: int = 2, top: int = 20) -> DataFrame:
    """The commonest pairs of source rows and external turns of a dialogue."""
    rows = source.groupBy("dialogue_id").agg(F.count("*").alias("source_rows"))
    pairs = rows.join(external.select("dialogue_id", F.size("turns").alias("external_turns")), "dialogue_id")
    found = pairs.groupBy("source_rows", "external_turns").agg(F.count("*").alias("dialogues"))
    return found.withColumn("matches", F.col("external_turns") == F.col("source_rows") * turns_per_row).orderBy(F.desc("dialogues"), "source_rows", "external_turns").limit(top)
