"""Duplicates: by content, by key, and conflicting ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def signature(*parts: Column) -> Column:
    """A hash of the parts' canonical text; nulls count."""
    return F.sha2(F.to_json(F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)]), {"ignoreNullFields": "false"}), 256)


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str], *values: str) -> DataFrame:
    """keys and the values of the first row of each key by the order columns.

    An aggregate, so that each task hands on one row for each key it has; the order must be unique in a key.
    """
    first = F.min_by(F.struct(*values), F.struct(*order))
    return rows.groupBy(*keys).agg(first.alias("_first")).select(*keys, *[F.col(f"_first.{v}").alias(v) for v in values])


def dedupe_union(rows: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], union: str) -> DataFrame:
    """As first_per_key(), and `union`: the sorted distinct elements of that array of all the key's rows."""
    found = rows.groupBy(*keys).agg(
        F.min_by(F.struct(*values), F.struct(*order)).alias("_first"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(union)))).alias(union),
    )
    return found.select(*keys, *[F.col(f"_first.{v}").alias(v) for v in values], union)


def conflicts(rows: DataFrame, keys: Sequence[str], outcome: Sequence[str], *counted: Column) -> DataFrame:
    """keys, n, n_outcomes and conflict of each group: a group with two outcomes is dropped as a whole. Nulls are values."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct(F.struct(*outcome)).alias("n_outcomes"), *counted).withColumn("conflict", F.col("n_outcomes") > 1)


def renumber(rows: DataFrame, partition: Sequence[str], order: Sequence[str], prefix: Column, number: str = "id") -> DataFrame:
    """`number`: prefix-Entry1, prefix-Entry2, ... in each partition by order; the old one stays as original_<number>."""
    w = Window.partitionBy(*partition).orderBy(*order)
    out = rows.withColumn(f"original_{number}", F.col(number)) if number in rows.columns else rows
    return out.withColumn(number, F.concat(prefix, F.lit("-Entry"), F.row_number().over(w)))


def unique_suffixes(rows: DataFrame, partition: Sequence[str], order: Sequence[str], key: str) -> DataFrame:
    """`unique_key`: repeats of a key get _2, _3, ...; a literal key that looks like that keeps it, and the repeat goes on
    to the next free number.

    The n-th row of a key gets the (n - 1)-th number from 2 on that no literal key of its takes. Literals are laid between
    the rows in the order of the numbers they shift, so a running count gives each row its own: sorts, and no pairs.
    """
    scope = [*partition, key]
    kept = rows.select(*partition, *order, key).withColumn("_n", F.row_number().over(Window.partitionBy(*scope).orderBy(*order)))
    literal = rows.select(*partition, F.regexp_extract(key, r"(?s)\A(.*)_([2-9]|[1-9]\d+)\z", 1).alias("_base"), F.regexp_extract(key, r"(?s)\A(.*)_([2-9]|[1-9]\d+)\z", 2).try_cast("long").alias("_i"))
    literal = literal.filter("_i is not null").distinct()
    shift = F.col("_i") - F.row_number().over(Window.partitionBy(*partition, "_base").orderBy("_i")) + 1
    taken = literal.select(*partition, F.col("_base").alias(key), shift.alias("_n"), F.lit(0).alias("_kind"))
    both = kept.withColumn("_kind", F.lit(1)).unionByName(taken, allowMissingColumns=True)
    passed = F.count_if(F.col("_kind") == 0).over(Window.partitionBy(*scope).orderBy("_n", "_kind").rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("_passed", passed).filter("_kind = 1")
    unique = F.when(F.col("_n") == 1, F.col(key)).otherwise(F.concat(key, F.lit("_"), (F.col("_n") + F.col("_passed")).cast("string")))
    return found.select(*partition, *order, key, unique.alias("unique_key"))
