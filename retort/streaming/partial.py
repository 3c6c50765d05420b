"""Output that grows batch by batch, can be read while it is partial, and goes on where a killed run stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retort.storage import materialize

_STATUS = "is_partial boolean, batches long"


def _set_status(spark: SparkSession, path: str, partial: bool, batches: int) -> None:
    spark.createDataFrame([(partial, batches)], _STATUS).coalesce(1).write.mode("overwrite").parquet(f"{path}/status")


def _batches(spark: SparkSession, path: str) -> int:
    """The number of batches whose rows are there."""
    try:
        return spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows").select("batch").distinct().count()
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return 0
        raise


def run_resumable(stream: DataFrame, work: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> None:
    """Do `work` on all that the stream has, one batch after another, and store the rows of each below path.

    A batch replaces its own folder, so that one which is done twice counts once; work must give the same columns for
    every batch. The status is partial from the first batch on and whole once all are done: a run that fails or is killed
    leaves the batches before, and the next run with the same checkpoint goes on with the one that failed. How much is in
    a batch is the stream's option (`maxFilesPerTrigger`). An empty stream makes an empty, whole output.
    """
    spark = stream.sparkSession

    def store(rows: DataFrame, batch: int) -> None:
        _set_status(rows.sparkSession, path, True, batch)
        work(rows).write.mode("overwrite").parquet(f"{path}/rows/batch={batch}")

    query = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    _set_status(spark, path, False, _batches(spark, path))


def read_partial(spark: SparkSession, path: str) -> tuple[DataFrame, bool]:
    """(the rows of all finished batches, with `batch`; whether more are to come). No status at all counts as partial."""
    rows = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    try:
        state = spark.read.schema(_STATUS).parquet(f"{path}/status").first()
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        state = None
    return rows, state is None or state["is_partial"]


def append_samples(rows: DataFrame, path: str, day: str = "day", time: str = "created_at") -> None:
    """Append samples to the folder of their day."""
    rows.withColumn(day, F.to_date(time)).write.mode("append").partitionBy(day).parquet(path)


def rewrite_samples(spark: SparkSession, path: str, days: list[str] | None = None, day: str = "day", time: str = "created_at", file_rows: int = 5_000_000) -> None:
    """Rewrite the days of a table of samples in the order of their time, as few files each; all days, or those given.

    The rows are stored apart first, and only folders of days that are read are replaced, so that a rewrite which fails
    can be done again from its stored copy and other days stay as they are. A day takes one file for each file_rows rows.
    """
    table = spark.read.parquet(path)
    kept = materialize(table if days is None else table.filter(F.col(day).cast("string").isin(*days)))
    if kept.isEmpty():
        return
    sizes = kept.groupBy(day).agg(F.ceil(F.count("*") / file_rows).alias("_files"))
    # Files of one day are cut by a hash of the rows; each is in the order of time.
    dealt = kept.join(F.broadcast(sizes), kept[day].eqNullSafe(sizes[day])).drop(sizes[day]).withColumn("_file", F.pmod(F.xxhash64(*kept.columns), F.col("_files")))
    dealt = dealt.repartition(day, "_file").sortWithinPartitions(day, "_file", time).drop("_file", "_files")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def summarize_samples(samples: DataFrame) -> DataFrame:
    """Samples, errors, peak memory and mean utilisation of each GPU; null numbers count nowhere."""
    failed = F.coalesce(F.col("error"), F.lit("")) != ""
    return samples.groupBy("gpu_index").agg(
        F.count(F.when(~failed, 1)).alias("samples"),
        F.count(F.when(failed, 1)).alias("errors"),
        F.max("memory_used").alias("peak_memory"),
        F.avg("utilization").alias("mean_utilization"),
        F.max("elapsed_seconds").alias("seconds"),
    )
