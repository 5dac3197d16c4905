"""Statistics of scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.files import checkpointed

def score_stats(score: str = "score") -> list[Column]:
    return [F.count(score).alias("n"), T.rounded(F.avg(score), 3).alias("mean"), F.min(score).alias("min"), F.max(score).alias("max")]


def evaluation_summary(records: DataFrame, keys: list[str]) -> DataFrame:
    """Score statistics overall and by each key, in one pass."""
    scored = records.where("score is not null")
    sets = [[], *([k] for k in keys)]
    found = scored.groupingSets(sets, *keys).agg(*score_stats(), *(F.grouping(k).alias(f"g_{k}") for k in keys))
    kind = F.lit("overall")
    for k in keys:
        kind = F.when(F.col(f"g_{k}") == 0, k).otherwise(kind)
    return found.select(kind.alias("kind"), F.coalesce(*(F.col(k).cast("string") for k in keys), F.lit("")).alias("key"), "n", "mean", "min", "max")


def group_means(records: DataFrame, group: str, group_count: str) -> DataFrame:
    """Balanced mean (of rounded group means) and the mean weighted by the sizes of groups in the whole data."""
    means = records.where("score is not null").groupBy(group).agg(T.rounded(F.avg("score"), 3).alias("mean"), F.max(group_count).alias("size"))
    return means.agg(T.rounded(F.avg("mean"), 3).alias("balanced_mean"), T.rounded(F.try_divide(F.sum(F.col("mean") * F.col("size")), F.sum("size")), 3).alias("weighted_mean"))


def status_counts(records: DataFrame, status: str = "status") -> DataFrame:
    return records.groupBy(F.coalesce(status, F.lit("None")).alias("status")).agg(F.count("*").alias("n"))


def pearson(x: str, y: str) -> Column:
    """Null for fewer than two rows or a constant column."""
    a, b = F.when(F.col(y).isNotNull(), F.col(x)), F.when(F.col(x).isNotNull(), F.col(y))
    return T.rounded(F.try_divide(F.covar_pop(x, y), F.stddev_pop(a) * F.stddev_pop(b)), 4)


def earlier_counts(counts: DataFrame, value: str, n: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """counts (keys, value, n: one row of each value) with `_before`: the n of all smaller values of the same keys.

    Values are sorted in ranges of (keys, value), which any number of tasks share; each range sums its own rows, and the sums of
    the ranges before it, of which there are as many as partitions, are added. So no task sees all values. The ranges are written
    first, as another run of the sort could cut them elsewhere.
    """
    by = [F.col(c) for c in (*keys, value)]
    ranged = checkpointed(counts.repartitionByRange(*by).withColumn("_range", F.spark_partition_id()))
    inside = Window.partitionBy("_range", *keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    own = ranged.withColumn("_own", F.coalesce(F.sum(n).over(inside), F.lit(0)))
    sums = ranged.groupBy(*keys, "_range").agg(F.sum(n).alias("_sum"), F.min(value).alias("_least"))
    # ranges of a key in their order: there are at most as many rows as partitions and keys
    starts = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(Window.partitionBy(F.lit(0) if not keys else F.col(keys[0]), *keys[1:]).orderBy("_least").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    same = F.lit(True)
    for c in keys:
        same &= F.col(f"o.{c}").eqNullSafe(F.col(f"s.{c}"))
    joined = own.alias("o").join(starts.alias("s"), same & (F.col("o._range") == F.col("s._range")))
    return joined.select(*(F.col(f"o.{c}").alias(c) for c in counts.columns), (F.col("o._own") + F.col("s._start")).alias("_before"))


def with_average_ranks(df: DataFrame, columns: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    """Ranks by value (of the same keys), ties sharing their mean rank. Counted by distinct value, so only distinct values are ranked, in ranges."""
    for c in columns:
        counts = df.groupBy(*keys, c).agg(F.count("*").alias("_n"))
        ranks = earlier_counts(counts, c, "_n", keys).withColumn(f"{c}_rank", F.col("_before") + (F.col("_n") + 1) / 2)
        df = df.join(ranks.drop("_n", "_before"), [*keys, c])
    return df


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    return with_average_ranks(df.where(F.col(x).isNotNull() & F.col(y).isNotNull()), [x, y]).agg(pearson(f"{x}_rank", f"{y}_rank").alias("spearman"))


def kappa(df: DataFrame, x: str, y: str, labels: list[str], quadratic: bool = False) -> DataFrame:
    """Agreement of two labellings beyond chance, from the table of their counts over a fixed order of labels."""
    spark, n = df.sparkSession, len(labels)
    grid = spark.createDataFrame([(a, b, float((i - j) ** 2) if quadratic else float(i != j)) for i, a in enumerate(labels) for j, b in enumerate(labels)], f"{x} string, {y} string, weight double")
    cells = df.where(F.col(x).isin(labels) & F.col(y).isin(labels)).groupBy(x, y).agg(F.count("*").alias("n"))
    cells = F.broadcast(grid).join(cells, [x, y], "left").fillna(0, ["n"])  # labels squared rows
    cells = cells.withColumns({"row": F.sum("n").over(Window.partitionBy(x)), "column": F.sum("n").over(Window.partitionBy(y))})
    total = F.sum("n")
    del n
    observed, expected = F.sum(F.col("weight") * F.col("n")), F.try_divide(F.sum(F.col("weight") * F.col("row") * F.col("column")), total)
    return cells.agg(T.rounded(1 - F.try_divide(observed, expected), 4).alias("kappa"))


def usage_summary(records: DataFrame, *keys: str) -> DataFrame:
    """Requests, tokens, cost, retries and waits. A request is a record with any usage value; means are by request."""
    values = ["usage_prompt_tokens", "usage_completion_tokens", "usage_total_tokens", "usage_cost"]
    asked = F.coalesce(*(F.col(v).cast("double") for v in values)).isNotNull()
    total = F.coalesce("usage_total_tokens", F.col("usage_prompt_tokens") + F.col("usage_completion_tokens"))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return records.groupBy(*keys).agg(
        F.count_if(asked).alias("requests"), zero("usage_prompt_tokens").alias("prompt_tokens"), zero("usage_completion_tokens").alias("completion_tokens"), zero(total).alias("total_tokens"),
        T.rounded(F.sum("usage_cost"), 6).alias("cost"), T.rounded(F.try_divide(F.sum(total), F.count_if(asked)), 4).alias("mean_tokens"),
        T.rounded(F.try_divide(F.sum("usage_cost"), F.count_if(asked)), 4).alias("mean_cost"),
        zero(F.greatest(F.coalesce("attempts", F.lit(1)) - 1, F.lit(0))).alias("retries"), zero("rate_limit_waits").alias("waits"),
        T.rounded(F.coalesce(F.sum(wait_seconds(records)), F.lit(0.0)), 4).alias("wait_seconds"),
    )


def wait_seconds(records: DataFrame) -> Column:
    return F.col("rate_limit_wait_seconds") if "rate_limit_wait_seconds" in records.columns else F.lit(None).cast("double")


def benchmark_stats(rows: DataFrame, labels: list[str], *keys: str) -> DataFrame:
    """By keys: rows, mean scores, correlations and agreements of judge and human. Null where there are too few rows or no variance.

    Ranks are taken inside each group over its distinct scores; agreements come from the table of bins.
    """
    rows = rows.withColumn("_all", F.lit(1))
    keys = ("_all", *keys)
    means = rows.groupBy(*keys).agg(F.count("*").alias("n"), T.rounded(F.avg("human_score_raw"), 4).alias("mean_human_score"), T.rounded(F.avg("llm_score"), 4).alias("mean_llm_score"), pearson("human_score_raw", "llm_score").alias("pearson"))
    ranked = with_average_ranks(rows, ["human_score_raw", "llm_score"], keys)
    ranks = ranked.groupBy(*keys).agg(pearson("human_score_raw_rank", "llm_score_rank").alias("spearman"))
    place = lambda c: F.array_position(F.array(*(F.lit(x) for x in labels)), F.col(c)) - 1
    cells = rows.where(F.col("human_bin").isin(labels) & F.col("llm_bin").isin(labels)).groupBy(*keys, place("human_bin").alias("i"), place("llm_bin").alias("j")).agg(F.count("*").alias("c"))
    cells = cells.withColumns({"row": F.sum("c").over(Window.partitionBy(*keys, "i")), "column": F.sum("c").over(Window.partitionBy(*keys, "j"))})
    # marginals: one row of each label; the expected table is their product
    sides = cells.groupBy(*keys).agg(F.collect_set(F.struct("i", "row")).alias("rows"), F.collect_set(F.struct("j", "column")).alias("columns"), F.sum("c").alias("total"), F.sum(F.when(F.col("i") != F.col("j"), F.col("c")).otherwise(0)).alias("differ"), F.sum((F.col("i") - F.col("j")) ** 2 * F.col("c")).alias("apart"))
    products = F.flatten(F.transform("rows", lambda r: F.transform("columns", lambda c: F.struct((r["i"] - c["j"]).alias("d"), (r["row"] * c["column"]).cast("double").alias("p")))))
    expected = lambda weight: F.aggregate(products, F.lit(0.0), lambda s, x: s + weight(x["d"]) * x["p"]) / F.col("total")
    agreement = lambda observed, weight: T.rounded(1 - F.try_divide(F.col(observed).cast("double"), expected(weight)), 4)
    kappas = sides.select(*keys, agreement("differ", lambda d: F.when(d != 0, 1.0).otherwise(0.0)).alias("cohen_kappa"), agreement("apart", lambda d: (d * d).cast("double")).alias("quadratic_weighted_kappa"))
    return means.join(ranks, list(keys), "left").join(kappas, list(keys), "left").drop("_all")


def benchmark_summary(records: DataFrame, labels: list[str]) -> DataFrame:
    """By model, and by model and language pair: records, those that are ok, statuses and statistics. lp is null in a model's own row."""
    usable = records.where((F.trim("status") == "ok") & F.col("llm_score").isNotNull())
    both = lambda df: df.select("*", F.explode(F.array(F.lit(None).cast("string"), F.coalesce("lp", F.lit("")))).alias("_lp"))
    counts = records.groupBy("model").agg(F.count("*").alias("rows"), F.count_if((F.trim("status") == "ok") & F.col("llm_score").isNotNull()).alias("ok_rows"))
    statuses = records.groupBy("model", F.coalesce("status", F.lit("None")).alias("status")).agg(F.count("*").alias("n")).groupBy("model").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("status_counts"))
    keyed_rows = both(usable).withColumn("_key", F.coalesce("_lp", F.lit("\u0000")))  # null does not join
    found = benchmark_stats(keyed_rows, labels, "model", "_key")
    used = usage_summary(keyed_rows, "model", "_key").select("model", "_key", "requests", "prompt_tokens", "completion_tokens", "total_tokens", "cost")
    out = found.join(used, ["model", "_key"]).withColumn("lp", F.when(F.col("_key") != "\u0000", F.col("_key"))).drop("_key")
    models = counts.join(statuses, "model")
    return models.join(out, "model", "left")
