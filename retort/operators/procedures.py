"""General procedures: their titles, aliases, scopes and templates, and what of a text refers to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retort.functions import text as t
from retort.functions import vocab
from retort.operators.dedupe import first_per_key
from retort.operators.resolve import contains_join, range_join

_DASHES = r"\-\u2010-\u2015"
_TITLE = r"(?i)\bgeneral\s+(?:experimental\s+)?procedure\s+(?:for\s+)?([A-Z0-9]{1,3})\b"


def section_title(title: Column) -> Column:
    """A section's title for comparison: no numbering, lower-cased, single-spaced, without trailing signs."""
    return t.squeeze(F.regexp_replace(F.regexp_replace(F.lower(title), r"\A\s*(?:[ivx]+|\d+|s\d+)(?:\.\d+)*[.)]?\s+", ""), r"[\s.:;]+\z", ""))


def is_heading(line: Column, words: Column) -> Column:
    """Whether a line holds all words of a title and little else."""
    return F.forall(words, lambda w: F.contains(F.lower(line), w)) & (F.char_length(line) <= 2 * F.char_length(F.array_join(words, " ")) + 10)


def gp_key(title: Column) -> Column:
    """The letter or number of a general procedure's title, upper-cased; null if it has none."""
    return F.nullif(F.upper(F.regexp_extract(title, _TITLE, 1)), F.lit(""))


def embedded_procedures(texts: DataFrame, key: str = "gp_key", text: str = "text") -> DataFrame:
    """gp_key and text of each procedure, those that hold several "Procedure A (for products 3a-3k)" cut into these, which
    are named by letter and products; white space around a part goes."""
    heading = r"(?:^|\n)\s*(?:\d+\)\s*)?Procedure\s+[A-Z]\s*\((?:for\s+)?[^)]+?\b(?:products?|compounds?)\s+[A-Za-z]?\d+[A-Za-z]*\s*[-\u2010-\u2015]\s*[A-Za-z]?\d+[A-Za-z]*\)"
    at = F.split(text, rf"(?i)(?={heading})")
    begins = rf"(?i)\A\s*(?:\d+\)\s*)?Procedure\s+([A-Z])\s*\((?:for\s+)?[^)]+?\b(?:products?|compounds?)\s+([A-Za-z]?\d+[A-Za-z]*)\s*[-\u2010-\u2015]\s*([A-Za-z]?\d+[A-Za-z]*)\)"
    parts = texts.withColumn("_parts", F.filter(at, lambda p: p.rlike(begins))).withColumn("_parts", F.when(F.size("_parts") >= 2, F.col("_parts")))
    part = parts.select("*", F.explode_outer("_parts").alias("_part"))
    name = F.concat(F.lit("GeneralProcedure"), F.upper(F.regexp_extract("_part", begins, 1)), F.lit("_"), F.regexp_extract("_part", begins, 2), F.lit("-"), F.regexp_extract("_part", begins, 3))
    return part.select(*[c for c in texts.columns if c not in (key, text)], F.coalesce(name, F.col(key)).alias(key), F.coalesce(t.strip(F.col("_part")), F.col(text)).alias(text))


def gp_aliases(key: Column) -> Column:
    """How texts call a general procedure, longest first."""
    names = F.array(*[F.concat(F.lit(p), F.lower(key)) for p in ("general procedure ", "procedure ", "method ", "gp-", "gp ", "gp")])
    return F.array_sort(names, lambda a, b: F.when(F.char_length(a) != F.char_length(b), F.char_length(b) - F.char_length(a)).when(a < b, -1).when(a > b, 1).otherwise(0))


def refers_to_gp(text: Column) -> Column:
    """Whether a text says that a general procedure was followed."""
    said = text.rlike(r"(?i)\b(?:according\s+to|following)\s+(?:the\s+)?(?:general\s+)?procedures?\b")
    return said | text.rlike(rf"\bGP[\s{_DASHES}]*[A-Z0-9]+\b") | text.rlike(r"\bGeneralProcedure[A-Z0-9]+\b")


def refers_to_some_gp(text: Column) -> Column:
    """Whether a text says so without a letter or number that tells which."""
    general = r"\b(?:according\s+to|following)\s+(?:the\s+)?general procedure\b(?!\s+[A-Z0-9]\b)"
    return text.rlike(rf"(?i){general}|\bfollowing\s+(?:the\s+)?procedures?\b(?!\s+[A-Z0-9]\b)")


def told_after(after: Column) -> Column:
    """Whether what follows a title tells what is done: a word of work in 300 characters, none of reference in the first 100."""
    near, far = F.lower(F.substring(after, 1, 100)), F.lower(F.substring(after, 1, 300))
    any_of = lambda c, words: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(c, w))
    return any_of(far, vocab.PROCEDURE_DEFINITIONS) & ~any_of(near, vocab.PROCEDURE_REFERENCES)


def named_before(before: Column) -> Column:
    """Whether what precedes a title refers to it: the last 160 characters, page marks aside, end in such words."""
    last = t.squeeze(F.regexp_replace(F.substring(before, F.greatest(F.char_length(before) - 159, F.lit(1)), F.lit(160)), r"(?i)---\s*Page\s+\d+\s*---", " "))
    return last.rlike(r"(?i)(?:according(?:\s+to|\s+the)?|following(?:\s+the|\s+procedures?)?)\s*$")


def defines_gp(text: Column, start: Column, end: Column) -> Column:
    """Whether the title from start to end (counted from 0, end exclusive) heads a procedure, and doesn't refer to one."""
    return told_after(F.substring(text, end + 1, F.lit(300))) & ~named_before(F.substring(text, F.lit(1), start))


def title_key(title: Column, after: Column | None = None) -> Column:
    """The public key of a procedure's title, or null if it has neither label, products nor words of its own.

    "GP-1:" keeps its label; "Typical procedure B:" is GeneralProcedureB; "... for 1a-3b and 5" is GeneralProcedure_1a-3b-5;
    a label anywhere after "procedure" counts next; else at most twelve words of the title, or of the text after a bare
    "General procedure", make the key.
    """
    head = t.strip(title)
    kinds = r"general\s+procedure|representative\s+procedure|typical\s+procedure|standard\s+procedure|standard\s+conditions|experimental\s+procedure|procedure"
    found = lambda pattern, n: F.nullif(F.regexp_extract(head, pattern, n), F.lit(""))
    short = rf"(?i)\A(?:\d+[).]\s*)?(GP)[\s{_DASHES}]*([A-Z0-9]+)\s*(?::|\uff1a|\.)"
    explicit = rf"(?i)\A(?:\d+[).]\s*)?(?:{kinds})\s+([A-Z0-9]+)\b\s*(?:\([^)\n]{{0,60}}\))?\s*(?::|\uff1a)"
    scope = r"(\d+\w*)\s*[-\u2013]\s*(\d+\w*)(?:\s+and\s+(\d+\w*))?"
    letter = r"(?i)procedure\s+([A-Z0-9]+)\b\s*(?::|\uff1a|\.|-|\u2013|\u2014|$)"
    named = lambda label: F.concat(F.lit("GeneralProcedure"), F.upper(label))
    products = F.concat(F.lit("GeneralProcedure_"), F.concat_ws("-", found(scope, 1), found(scope, 2), found(scope, 3)))
    bare = head.rlike(r"(?i)\A\s*general\s+procedures?\s*\z")
    source = head if after is None else F.when(bare & (F.coalesce(after, F.lit("")) != ""), F.substring(after, 1, 320)).otherwise(head)
    source = F.regexp_replace(F.regexp_replace(source, r"(?i)---\s*Page\s+\d+\s*---", " "), r"\bS\d+\b", " ")
    source = F.regexp_extract(source, r"\A[^:\uff1a]*", 0)
    source = F.get(F.split(source, r"(?i)\b(?:under|to\s+a|a\s+flask|in\s+a|the\s+reaction|a\s+mixture)\b", 2), F.lit(0))
    source = F.regexp_replace(source, r"(?i)\A\s*(?:(?:general|representative|typical|standard|experimental)\s+)?procedures?\b\s*(?:for|of|to|on)?\s*", "")
    source = F.lower(t.strip(F.regexp_replace(F.regexp_replace(source, r"(?i)\A\s*(?:the|a|an)\s+", ""), r"[^A-Za-z0-9]+", " ")))
    words = F.filter(F.split(source, " "), lambda w: w != "")
    slug = F.regexp_replace(F.substring(F.array_join(F.slice(words, 1, 12), "_"), 1, 96), r"\A_+|_+\z", "")
    return F.coalesce(
        F.when(head.rlike(short), F.concat(found(short, 1), F.lit("-"), found(short, 2))),
        F.when(head.rlike(explicit), named(found(explicit, 1))),
        F.when(head.rlike(scope), products),
        F.when(head.rlike(letter), named(found(letter, 1))),
        F.when((F.size(words) >= 2) & (F.char_length(slug) >= 8), F.concat(F.lit("GeneralProcedure_"), slug)),
    )


def keyed_titles(titles: DataFrame, scope: Sequence[str], order: str, after: str | None = None) -> DataFrame:
    """titles with gp_key: title_key(), and for those without one GeneralProcedureUnlabeled1, 2, ... in the scope's order.
    Only the titles without a key are numbered by a window."""
    keyed = titles.withColumn("gp_key", title_key(F.col("title"), None if after is None else F.col(after)))
    n = F.row_number().over(Window.partitionBy(*scope).orderBy(order))
    rest = keyed.filter("gp_key is null").withColumn("gp_key", F.concat(F.lit("GeneralProcedureUnlabeled"), n.cast("string")))
    return keyed.filter("gp_key is not null").unionByName(rest)


def match_aliases(texts: DataFrame, procedures: DataFrame, text: str = "text") -> DataFrame:
    """texts x procedures (gp_key, pos, alias) whose alias the text holds; each pair once, by its longest alias."""
    met = contains_join(texts.withColumn("_t", F.lower(text)), procedures.select("gp_key", "pos", "alias"), "_t", "alias").drop("_t")
    keep = [c for c in texts.columns]
    return met.groupBy(*keep, "gp_key", "pos").agg(F.max(F.struct(F.char_length("alias").alias("n"), "alias"))["alias"].alias("alias"))


def template_for(reactions: DataFrame, templates: DataFrame, order: str = "pos") -> DataFrame:
    """reactions (row_id, gp_source, id) with the gp_key of their template: the one that gp_source names, else the first
    whose alias their id holds."""
    exact = reactions.join(templates.select("gp_key", order), F.upper("gp_source") == F.col("gp_key")).select("row_id", F.lit(0).alias("rank"), order, "gp_key")
    by_id = contains_join(reactions.withColumn("_t", F.lower("id")), templates.select("gp_key", order, F.explode(gp_aliases(F.col("gp_key"))).alias("alias")), "_t", "alias").select("row_id", F.lit(1).alias("rank"), order, "gp_key")
    best = first_per_key(exact.unionByName(by_id), ["row_id"], ["rank", order], "gp_key")
    return reactions.join(best, "row_id", "left")


def override(templates: DataFrame, entries: DataFrame, key: Sequence[str], fields: str = "fields") -> DataFrame:
    """entries' maps laid over their templates' maps; entries without a template keep their own."""
    base = templates.select(*key, F.col(fields).alias("_base"))
    out = entries.join(base, list(key), "left")
    rest = F.map_filter(F.coalesce("_base", F.expr("cast(map() as map<string,string>)")), lambda k, _: ~F.map_contains_key(fields, k))
    return out.withColumn(fields, F.map_concat(rest, fields)).drop("_base")


def gp_log(texts: DataFrame, templates: DataFrame, records: DataFrame) -> DataFrame:
    """gp_key and status of every procedure that has a text, a template or a record: valid, invalid, or error without a template."""
    a = texts.select("gp_key", F.col("pos").alias("text_pos"))
    b = templates.select("gp_key", "valid")
    c = records.select("gp_key", F.lit(True).alias("recorded"))
    out = a.join(b, "gp_key", "full_outer").join(c, "gp_key", "full_outer")
    status = F.when(F.col("valid"), "valid").when(~F.col("valid"), "invalid").otherwise("error")
    return out.select("gp_key", "text_pos", status.alias("status"), F.coalesce("recorded", F.lit(False)).alias("recorded"))


def in_scope(products: DataFrame, scopes: DataFrame, number: str = "number", width: int = 16) -> DataFrame:
    """products with the gp_key of the first procedure (gp_key, pos, low, high) whose numbers hold theirs."""
    met = range_join(products.select(number).distinct(), scopes, number, "low", "high", width)
    return products.join(first_per_key(met, [number], ["pos"], "gp_key"), number, "left")


def span_pages(spans: DataFrame, markers: DataFrame, scope: Sequence[str]) -> DataFrame:
    """scope, span_id and pages of spans (start, end) of a text with page markers (at, page): the last marker at or before
    the start, and those inside. One aggregate over a join within each scope, whose markers are few."""
    met = spans.join(markers, list(scope)).filter(F.col("at") < F.col("end"))
    first = F.max(F.when(F.col("at") <= F.col("start"), F.struct("at", "page")))["page"]
    inside = F.collect_set(F.when(F.col("at") > F.col("start"), F.col("page")))
    return met.groupBy(*scope, "span_id").agg(F.array_sort(F.array_distinct(F.array_compact(F.concat(F.array(first), inside)))).alias("pages"))


def section_chunks(chosen: DataFrame, sections: DataFrame, pages: DataFrame, scope: Sequence[str]) -> DataFrame:
    """scope, title, page_nums and preview (1200 characters) of the chosen sections (title, start_page, end_page)."""
    known = sections.join(chosen, [*scope, "title", "start_page", "end_page"], "left_semi")
    met = range_join(pages, known.withColumnsRenamed({s: f"_{s}" for s in scope}), "page_num", "start_page", "end_page", 8)
    for s in scope:
        met = met.filter(F.col(s) == F.col(f"_{s}"))
    listed = F.array_sort(F.collect_list(F.struct("page_num", "text")))
    out = met.groupBy(*scope, "title", "start_page", "end_page").agg(listed.alias("_p"))
    return out.select(*scope, "title", F.transform("_p", lambda p: p["page_num"]).alias("page_nums"), F.substring(F.array_join(F.transform("_p", lambda p: p["text"]), "\n"), 1, 1200).alias("preview"))


def render_template(fields: Column) -> Column:
    """A template's fields as lines "key: value", by key."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(fields)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
