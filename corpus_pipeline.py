"""A corpus pipeline of five stages, each calling one operator of dialoom.llm.

Every stage takes nulls in any column, empty and very long texts, repeated rows and an empty table: null and empty texts are
not toxic, have no near copies, no repeated strings and no benchmark passages, and go on to packing, where each is one token. Extra
columns go along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm import decontamination, minhash, packing, substrings, toxicity
from dialoom.llm.queries import toxicity_model
from dialoom.llm.shared import Scratch


#: Tables of the stages so far. A stage's rows are written before the next one is called, so that one deletes them.
LEFT: list[Scratch] = []


def stage_scratch(spark: SparkSession, name: str) -> Scratch:
    while LEFT:
        LEFT.pop().clear()
    LEFT.append(Scratch(spark, name))
    return LEFT[-1]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    return toxicity.score_texts(docs, toxicity_model(spark, sf_dir), score="toxicity").where("toxicity < 0.5").select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: five-word shingles, similarity 0.8 or more. Repeated rows and rows without doc_id are rows like any other."""
    scratch = stage_scratch(spark, "near-copies")
    LEFT.append(Scratch(spark, "minhash"))
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*docs.columns).alias("doc"))
    rows = scratch.keep_bucketed(numbered, "row", "rows")  # written, so that a row keeps its number
    found = minhash.near_duplicates(rows.select("row", "doc.text"), doc_id="row", scratch=LEFT[-1], own_ids=True).select(F.col("doc_id").alias("row"), "component_id")
    # the row of the least doc_id stays
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("row"))
    kept = found.join(rows.select("row", F.col("doc.doc_id").alias("id")), "row").groupBy("component_id").agg(F.min_by("row", order).alias("row"))
    out = rows.join(scratch.keep(kept, "kept"), "row", "left_semi").select("doc.*")
    scratch.forget("rows")
    return out


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that occur more than once; documents of which nothing is left go."""
    found = substrings.remove_repeats(docs, scratch=stage_scratch(spark, "repeats")).where("n_removed = 0 or trim(text) <> ''")
    columns = {c: F.col(f"rest.{c}") for c in docs.columns if c not in ("doc_id", "text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(columns["n_chars"])
    return found.select(*(columns.get(c, F.col(c)).alias(c) for c in docs.columns))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    stage_scratch(spark, "leaks")
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences of 2048 tokens."""
    from public_tokenizers import path

    stage_scratch(spark, "packing")
    return packing.pack_documents(docs, path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash", drop_near_copies),
    ("repeats", drop_repeats),
    ("decontamination", drop_leaks),
    ("packing", pack),
]
#: No stage but the second can be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over the whole documents table."""
    scratch, docs = Scratch(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
