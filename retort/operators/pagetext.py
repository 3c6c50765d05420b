"""Text of pages from the boxes of their words: lines by gaps, columns by the middle of the page."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retort.functions import text as t

#: Body of a page, and the part of it that columns are read from, as shares of the height; sides as shares of the width.
BODY, COLUMNS, SIDES = (0.08, 0.94), (0.06, 0.96), (0.43, 0.57)
#: A two-column page has so many body words, at least so many and such a share of them on each side, and such a balance.
LEAST_WORDS, LEAST_SIDE, LEAST_SHARE, BALANCE = 120, 30, 0.18, 0.45
#: Text of columns counts if it has so many characters and such a share of those of the page read across.
LEAST_CHARS, LEAST_KEPT = 80, 0.4


def lines_of(words: Column, tolerance: float) -> Column:
    """Text of a page's or side's words (array<struct<top, x0, text, ...>>, in that order): words whose tops follow each
    other within the tolerance are a line, read by x0; lines are joined by line ends, from the top down."""
    begins = lambda w, i: (i == 0) | F.coalesce(w[i]["top"] - F.get(w, i - 1)["top"] > tolerance, F.lit(True))
    starts = lambda w: F.filter(F.transform(w, lambda _, i: F.when(begins(w, i), i)), lambda i: i.isNotNull())
    line = lambda ws: F.array_join(F.transform(F.array_sort(F.transform(ws, lambda w: F.struct(w["x0"], w["top"], w["text"]))), lambda w: w["text"]), " ")
    cut = lambda w, at: F.transform(at, lambda i, k: line(F.slice(w, i + 1, F.coalesce(F.get(at, k + 1), F.size(w)) - i)))
    return F.array_join(t.bound(words, lambda w: t.bound(starts(w), lambda at: cut(w, at))), "\n")


def page_texts(words: DataFrame, page: Sequence[str], layout: str = "auto", tolerance: float = 3.0) -> DataFrame:
    """page, two_column and text of the pages of words (page, text, x0, x1, top, bottom, page_width, page_height).

    layout `single` reads all pages across, `two_column` reads each page's left and then its right half, `auto` those
    that look so. A word belongs to the half that holds its middle; halves leave out the page's upper and lower margin.
    Where the columns give too little text (80 characters, 40 %), the page is read across after all. Blank words and
    pages without any are left out. Words are gathered and sorted once a page, and arrays do the rest: no group is larger
    than a page.
    """
    page = list(page)
    words = words.filter(t.strip(F.col("text")) != "")
    if layout != "single":
        words = words.dropna(subset=page)
    inside = (F.col("bottom") > COLUMNS[0] * F.col("page_height")) & (F.col("top") < COLUMNS[1] * F.col("page_height"))
    side = F.coalesce((F.col("x0") + F.col("x1") > F.col("page_width")).cast("int"), F.lit(-1))
    body = F.col("top").between(BODY[0] * F.col("page_height"), BODY[1] * F.col("page_height"))
    left = F.count_if(body & (F.col("x0") < SIDES[0] * F.col("page_width")))
    right = F.count_if(body & (F.col("x1") > SIDES[1] * F.col("page_width")))
    item = F.struct("top", "x0", "text", F.when(inside, side).alias("side"))
    pages = words.groupBy(*page).agg(F.sort_array(F.collect_list(item)).alias("_words"), F.count_if(body).alias("n"), left.alias("l"), right.alias("r"))
    pages = pages.select(*page, "_words", lines_of(F.col("_words"), tolerance).alias("_across"), "n", "l", "r")
    if layout == "single":
        return pages.select(*page, F.lit(False).alias("two_column"), F.col("_across").alias("text"))
    half = lambda s: F.filter("_words", lambda w: w["side"] == s)
    sides = F.filter(F.array(half(-1), half(0), half(1)), lambda ws: F.size(ws) > 0)  # -1: a box without a place, before all
    columns = F.array_join(F.transform(sides, lambda ws: lines_of(ws, tolerance)), "\n\n")
    least, most = F.least("l", "r"), F.greatest("l", "r")
    looks = (F.col("n") >= LEAST_WORDS) & (least >= F.greatest(F.lit(LEAST_SIDE), F.floor(F.col("n") * LEAST_SHARE))) & (least >= BALANCE * most)
    # Only pages that are to be read in columns are: the others' columns aren't made.
    out = pages.select(*page, "_across", F.when(F.lit(True) if layout == "two_column" else looks, columns).alias("_columns"))
    out = out.select(*page, "_across", F.when(F.char_length("_columns") >= F.greatest(F.lit(LEAST_CHARS), F.floor(F.char_length("_across") * LEAST_KEPT)), F.col("_columns")).alias("_columns"))
    return out.select(*page, F.col("_columns").isNotNull().alias("two_column"), F.coalesce("_columns", "_across").alias("text"))
