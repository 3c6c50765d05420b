"""Sections, chunks and positions of ordered pages and rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def section_ends(starts: DataFrame, scope: Sequence[str], start: str, last: Column | None = None) -> DataFrame:
    """starts with `end_page`: one before the next start in the scope, `last` for the last one."""
    following = F.lead(start).over(Window.partitionBy(*scope).orderBy(start))
    return starts.withColumn("end_page", F.coalesce(following - 1, F.lit(None).cast("int") if last is None else last))


def fixed_chunks(rows: DataFrame, scope: Sequence[str], order: Sequence[str], size: int) -> DataFrame:
    """rows with `chunk`: 0 for the first `size` of the scope, 1 for the next, and so on."""
    n = F.row_number().over(Window.partitionBy(*scope).orderBy(*order))
    return rows.withColumn("chunk", F.floor((n - 1) / size).cast("int"))


def greedy_chunks(rows: DataFrame, scope: Sequence[str], order: str, length: Column, pages: int = 5, chars: int = 8000) -> DataFrame:
    """scope, chunk, orders (array) and chars: rows are added to a chunk until it has `pages` of them or would pass `chars`.

    The state goes from row to row, so a scope's rows (their order and length only) are folded as one array.
    """
    listed = rows.groupBy(*scope).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), length.cast("long").alias("c")))).alias("_rows"))
    empty = F.expr(f"cast(array() as array<struct<orders:array<{dict(rows.dtypes)[order]}>,chars:bigint>>)")

    def add(done: Column, x: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        full = (F.size(done) == 0) | (F.size(last["orders"]) >= pages) | (last["chars"] + x["c"] > chars)
        new = F.concat(done, F.array(F.struct(F.array(x["o"]).alias("orders"), x["c"].alias("chars"))))
        grown = F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(F.concat(last["orders"], F.array(x["o"])).alias("orders"), (last["chars"] + x["c"]).alias("chars"))))
        return F.when(full, new).otherwise(grown)

    return listed.select(*scope, F.posexplode(F.aggregate("_rows", empty, add)).alias("chunk", "_c")).select(*scope, "chunk", "_c.orders", "_c.chars")


def spans_of(texts: DataFrame, keep: Sequence[str], pattern: str, text: str = "text", near: int = 0) -> DataFrame:
    """keep, pos, title and end of the parts of a text that begin with matches of a pattern; a title within `near` characters
    of the next one is suppressed by it."""
    starts = texts.select(*keep, F.char_length(text).alias("_n"), F.posexplode(F.split(text, f"(?={pattern})")).alias("_i", "_part"))
    w = Window.partitionBy(*keep).orderBy("_i")
    placed = starts.withColumn("pos", F.coalesce(F.sum(F.char_length("_part")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    titled = placed.withColumn("title", F.regexp_extract("_part", rf"\A({pattern})", 1)).filter("title <> ''")
    after = titled.withColumn("_next", F.lead("pos").over(w)).filter(F.col("_next").isNull() | (F.col("_next") - F.col("pos") > near))
    return after.select(*keep, "pos", "title", F.coalesce(F.lead("pos").over(Window.partitionBy(*keep).orderBy("pos")), F.col("_n")).alias("end"))


def page_pairs(pages: DataFrame, scope: Sequence[str], order: str, text: str) -> DataFrame:
    """Each page, and each page with the one after it."""
    following = F.lead(text).over(Window.partitionBy(*scope).orderBy(order))
    both = pages.withColumn("_next", following)
    return both.select(*scope, order, F.inline(F.filter(F.array(F.struct(F.lit("page").alias("kind"), F.col(text).alias(text)), F.struct(F.lit("pair").alias("kind"), F.concat(text, F.lit("\n"), F.col("_next")).alias(text))), lambda x: x[text].isNotNull())))


def toc_offset(titles: DataFrame, pages: DataFrame, scope: str) -> DataFrame:
    """scope and offset between printed and real pages: the commonest, ties to the least distance, by each title's first page."""
    met = titles.join(pages, scope).filter(F.contains(F.lower(F.substring("text", 1, 400)), F.lower("title")))
    first = met.groupBy(scope, "title", "printed_page").agg(F.min("page_num").alias("page_num")).withColumn("offset", F.col("page_num") - F.col("printed_page"))
    counted = first.groupBy(scope, "offset").agg(F.count("*").alias("n"))
    return counted.groupBy(scope).agg(F.min(F.struct((-F.col("n")).alias("a"), F.abs("offset").alias("b"), F.col("offset").alias("offset")))["offset"].alias("offset"))


def top_k(rows: DataFrame, k: int, *order: Column) -> DataFrame:
    """The k first rows by an order that ends with a unique column; each task hands on k rows at most."""
    return rows.orderBy(*order).limit(k)
