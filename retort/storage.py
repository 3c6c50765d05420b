"""Tables at the ends of stages."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def fresh_path(spark: SparkSession) -> str:
    """A path below spark.checkpoint.dir, which all executors share, that nothing uses yet.

    Where the setting is unset a session with local executors only, as in tests, gets a temporary folder; on a cluster
    that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="retort-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/stages/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """df written below spark.checkpoint.dir and read back: its plan begins anew."""
    path = fresh_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
