"""Weighted rendezvous hashing of record keys over shards, in Spark expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retort.llm.common import parts_for, read, stored

SHARDS = 16
#: Rows that one task numbers at once.
RUN_ROWS = 65536


def scores(key: Column, shards: int, weights: Sequence[float] | None = None) -> Column:
    """array<struct<score, shard>>: weight / -ln(u) of a key for each shard, u a hash of key and shard.

    A shard's score doesn't depend on how many there are, so one array of a shard more serves for both counts. A null key
    counts as the string "null".
    """
    weights = [1.0] * shards if weights is None else list(weights)
    if len(weights) != shards or min(weights) <= 0:
        raise ValueError("one positive weight for each shard is needed")
    text = F.coalesce(key.cast("string"), F.lit("null"))

    def score(i: int) -> Column:
        digits = F.substring(F.md5(F.concat(text, F.lit(f"#{i}"))), 1, 13)
        unit = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)
        return F.struct((F.lit(weights[i]) / -F.log(unit)).alias("score"), F.lit(i).alias("shard"))

    return F.array(*[score(i) for i in range(shards)])


def rendezvous(key: Column, shards: int, weights: Sequence[float] | None = None) -> Column:
    """The shard (0 to shards-1) of a key: the one with the highest score.

    Only keys that a new shard wins move when it is added, and a shard gets keys in proportion to its weight. Scores
    never tie in practice; if they did, the higher shard number would win.
    """
    return F.array_max(scores(key, shards, weights))["shard"]


def number_within(df: DataFrame, shard: str, slot: str, row: str, run_rows: int = RUN_ROWS) -> DataFrame:
    """Number the rows of each shard gaplessly from 0 without gathering a shard in one task.

    `row` is a number of its own for each row; rows go to runs by its hash, however alike they are in all else. A row's
    slot is the sum of the sizes of the shard's earlier runs and its place by `row` in its own run.
    """
    runs = parts_for(df.count(), run_rows)
    df = df.withColumn("_run", F.pmod(F.xxhash64(row), F.lit(runs)))
    sizes = df.groupBy(shard, "_run").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(shard).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(shard, "_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(shard, "_run").orderBy(row)
    numbered = df.withColumn("_place", F.row_number().over(inside) - 1)
    return numbered.join(offsets, [shard, "_run"]).withColumn(slot, (F.col("_offset") + F.col("_place")).cast("long")).drop("_run", "_place", "_offset")


def shard(df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS, weights: Sequence[float] | None = None) -> DataFrame:
    """key, size, text_crc32, law, shard, slot and grown_shard of every row; other columns of df are ignored.

    A null text counts as empty (size 1, CRC 0). The law is `key`: the key and the shard count alone decide, so repeated
    keys share a shard, and grown_shard, with one more shard of weight 1, differs from shard only where it is the new
    one. Very long texts count by their size alone; rows alike in everything get slots of their own. An empty table
    gives an empty result.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    scored = df.select(
        F.col(key).alias("_key"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        scores(F.col(key), shards + 1, [*([1.0] * shards if weights is None else weights), 1.0]).alias("_scores"),
    )
    out = scored.select(
        "_key",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        F.array_max(F.slice("_scores", 1, shards))["shard"].alias("shard"),
        F.array_max("_scores")["shard"].alias("grown_shard"),
        F.monotonically_increasing_id().alias("_row"),
    )
    # Stored, without the texts, so that every row is scored once and keeps its number.
    out = number_within(stored(out), "shard", "slot", "_row")
    return out.select(F.col("_key").alias(key), "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents", "doc_id", "text"))
