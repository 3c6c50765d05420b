"""Rollups of usage, time and quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retort.functions import vocab


def grouped_sets(rows: DataFrame, keys: Sequence[str], *measures: Column) -> DataFrame:
    """One pass over rows: the measures in total and by each key alone. `by` tells which; its key's value is `value`."""
    rolled = rows.groupingSets([[], *[[F.col(k)] for k in keys]], *[F.col(k) for k in keys]).agg(*measures, *[F.grouping(k).alias(f"_g_{k}") for k in keys])
    by = F.coalesce(*[F.when(F.col(f"_g_{k}") == 0, F.lit(k)) for k in keys], F.lit("total"))
    value = F.coalesce(*[F.when(F.col(f"_g_{k}") == 0, F.col(k).cast("string")) for k in keys])
    kept = [c for c in rolled.columns if c not in keys and not c.startswith("_g_")]
    return rolled.select(by.alias("by"), value.alias("value"), *kept)


def usage(events: DataFrame) -> DataFrame:
    """Token usage of events in total, by model, stage and pdf; input_ and output_tokens stand in for the usual names."""
    have = events.columns
    pick = lambda *names: F.coalesce(*[F.col(n) for n in names if n in have], F.lit(0))
    prompt, completion = pick("prompt_tokens", "input_tokens"), pick("completion_tokens", "output_tokens")
    total = F.coalesce(F.col("total_tokens"), prompt + completion) if "total_tokens" in have else prompt + completion
    sums = [F.count("*").alias("calls"), F.sum(prompt).alias("prompt_tokens"), F.sum(completion).alias("completion_tokens"), F.sum(total).alias("total_tokens")]
    return grouped_sets(events, ("model", "stage", "pdf_name"), *sums)


def cost(usage_rows: DataFrame, prices: DataFrame) -> DataFrame:
    """usage (model, prompt_tokens, completion_tokens) with `usd`, by prices (model, input_usd, output_usd per million)."""
    usd = (F.col("prompt_tokens") * F.col("input_usd") + F.col("completion_tokens") * F.col("output_usd")) / 1e6
    return usage_rows.join(prices, "model").withColumn("usd", usd).drop("input_usd", "output_usd")


def default_prices(spark) -> DataFrame:
    return spark.createDataFrame([(k, *v) for k, v in vocab.USD_PER_MILLION_TOKENS.items()], "model string, input_usd double, output_usd double")


def event_kind(kind: Column, operation: Column, leaves: Sequence[str]) -> Column:
    """The explicit kind, else `leaf` for the operations that have no others inside."""
    return F.coalesce(F.nullif(F.lower(kind), F.lit("")), F.when(operation.isin(*leaves), "leaf").otherwise("wall"))


def timing(events: DataFrame, keys: Sequence[str], seconds: str = "elapsed_seconds") -> DataFrame:
    """Calls, seconds and the longest, in total and by each key; sums are rounded once, at the end."""
    s = F.col(seconds)
    return grouped_sets(events, keys, F.count("*").alias("calls"), F.bround(F.sum(s), 3).alias("seconds"), F.max(s).alias("longest"))


def overhead(events: DataFrame, keys: Sequence[str], kind: str = "event_kind", seconds: str = "elapsed_seconds") -> DataFrame:
    """Seconds of the whole less those of the leaves, by key."""
    part = lambda k: F.coalesce(F.sum(F.when(F.col(kind) == k, F.col(seconds))), F.lit(0.0))
    return events.groupBy(*keys).agg(part("wall").alias("wall"), part("leaf").alias("leaf"), (part("wall") - part("leaf")).alias("overhead"))


def gpu_summary(samples: DataFrame) -> DataFrame:
    """Most and mean memory, use and power of each GPU, and of all (gpu_index null)."""
    one = lambda c: [F.max(c).alias(f"max_{c}"), F.bround(F.avg(c), 2).alias(f"avg_{c}")]
    return samples.rollup("gpu_index").agg(F.count("*").alias("samples"), *one("memory_used"), *one("utilization"), *one("power"))


def batch_summary(records: DataFrame) -> DataFrame:
    return records.agg(F.count("*").alias("images"), F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") != "ok").alias("failed"), F.max("image_elapsed_seconds").alias("longest"), F.sum("image_elapsed_seconds").alias("seconds"))


def label_examples(rows: DataFrame, label: Sequence[str], order: str, example: str, n: int = 3) -> DataFrame:
    """label, n and the first examples by order, which must be unique in a label.

    Ranks are cut to n in each task before rows are dealt by label, so a common label gathers few.
    """
    rank = F.row_number().over(Window.partitionBy(*label).orderBy(order))
    first = rows.withColumn("_rank", rank).filter(F.col("_rank") <= n)
    examples = first.groupBy(*label).agg(F.transform(F.array_sort(F.collect_list(F.struct("_rank", example))), lambda x: x[example]).alias("examples"))
    return rows.groupBy(*label).agg(F.count("*").alias("n")).join(examples, list(label))


def distribution(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("n"))


def paper_summary(rows: DataFrame, papers: DataFrame, paper: str, modality: str, task: str, tasks: Sequence[str]) -> DataFrame:
    """Each paper and modality with its questions by task and in all; papers without any have zeros."""
    counts = rows.groupBy(paper, modality).agg(F.count("*").alias("n_questions"), *[F.count_if(F.col(task) == x).alias(f"n_{x}") for x in tasks])
    return papers.join(counts, [paper], "left").na.fill(0, ["n_questions", *[f"n_{x}" for x in tasks]])


def type_audit(rows: DataFrame, group: Sequence[str], kind: str) -> DataFrame:
    """group, its distinct types sorted, and whether there are several."""
    return rows.groupBy(*group).agg(F.array_sort(F.collect_set(kind)).alias("types")).withColumn("type_conflict", F.size("types") > 1)


def status_counts(rows: DataFrame, status: str, statuses: Sequence[str], file: str) -> DataFrame:
    """Counts of each status by file, and in all (file null)."""
    return rows.rollup(file).agg(F.count("*").alias("n"), *[F.count_if(F.col(status) == s).alias(s) for s in statuses])


def split_report(reactions: DataFrame, classes: DataFrame, key: str, paper: str, name: str) -> DataFrame:
    """By paper and in all (paper null): reactions, those of each class (classes: key, name, class), of neither, and names."""
    rows = reactions.join(classes, key, "left")
    sums = [F.count("*").alias("n"), F.count_if(F.col("class") == "Q1").alias("q1"), F.count_if(F.col("class") == "Q2").alias("q2"), F.count_if(F.col("class").isNull()).alias("unclassified"), F.count_distinct(name).alias("names")]
    return rows.rollup(paper).agg(*sums)


def enrichment_stats(compounds: DataFrame) -> DataFrame:
    """One row of counts of compounds (name, source, hit, parsed, error): how many had something to ask with, what answered
    them, and what is left."""
    asked = F.col("name") != ""
    hit, parsed, failed = asked & F.col("hit"), asked & ~F.col("hit") & F.col("parsed"), asked & ~F.col("hit") & (F.col("error") != "")
    return compounds.agg(
        F.count("*").alias("compounds"),
        F.count_if(~asked).alias("without_name"),
        F.count_if(asked).alias("with_name"),
        F.count_distinct(F.when(asked, F.col("name"))).alias("distinct_names"),
        F.count_if(hit).alias("cache_hits"),
        F.count_if(asked & ~F.col("hit")).alias("cache_misses"),
        F.count_if(parsed).alias("parsed"),
        F.count_if(failed).alias("failed"),
        F.count_if(asked & ~F.col("hit") & ~F.col("parsed") & (F.col("error") == "")).alias("pending"),
        F.count_if(hit | parsed).alias("enriched"),
    )


def run_summary(stages: DataFrame, paper: str = "paper", stage: str = "stage", status: str = "status", seconds: str = "seconds") -> DataFrame:
    """By stage and in all (stage null): papers, those that ended well, failed and were skipped, and their seconds."""
    one = lambda s: F.count_distinct(F.when(F.col(status) == s, F.col(paper))).alias(s)
    return stages.rollup(stage).agg(F.count_distinct(paper).alias("papers"), one("ok"), one("failed"), one("skipped"), F.bround(F.sum(seconds), 3).alias("seconds"))


def gp_summary(log: DataFrame, paper: str = "paper") -> DataFrame:
    """By paper: procedures, and how many are valid, invalid and in error, from a procedure log (paper, gp_key, status)."""
    return log.groupBy(paper).agg(F.count("*").alias("procedures"), *[F.count_if(F.col("status") == s).alias(s) for s in ("valid", "invalid", "error")])
