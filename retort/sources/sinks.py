"""Writers: edges, summaries, question bundles and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retort.functions.vocab import EDGE_COLUMNS
from retort.schemas import SUMMARY_COLUMNS


def write_edges(edges: DataFrame, path: str) -> None:
    """The fixed columns of edges as CSV; Spark's commit makes the files appear at once."""
    edges.select(*EDGE_COLUMNS).write.csv(path, header=True, mode="overwrite", emptyValue="")


def write_summary(summary: DataFrame, path: str) -> None:
    """The fixed columns of summaries as CSV, papers descending, the order in a paper kept."""
    ordered = summary.orderBy(F.lower("paper").desc(), "first_pos")
    ordered.select(*SUMMARY_COLUMNS).write.csv(path, header=True, mode="overwrite", emptyValue="")


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.json(path, mode="overwrite", ignoreNullFields=False)


def append_events(rows: DataFrame, path: str) -> None:
    rows.write.json(path, mode="append")


def write_bundle(parts: dict[str, DataFrame], root: str) -> DataFrame:
    """Each part below root, and a manifest (part, rows, sha256 of the sorted rows' hashes), which is returned too."""
    found = None
    for name, part in parts.items():
        write_json(part, f"{root}/{name}")
        lines = part.select(F.sha2(F.to_json(F.struct(*part.columns), {"ignoreNullFields": "false"}), 256).alias("h"))
        # Sums of hash parts don't depend on the order of rows, and are added where the rows are.
        sums = [F.sum(F.conv(F.substring("h", 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")) for i in range(4)]
        one = lines.agg(F.count("*").alias("rows"), F.sha2(F.concat_ws("-", *[F.coalesce(s, F.lit(0)).cast("string") for s in sums]), 256).alias("sha256"))
        one = one.select(F.lit(name).alias("part"), "rows", "sha256")
        found = one if found is None else found.unionByName(one)
    write_json(found, f"{root}/manifest")
    return found
