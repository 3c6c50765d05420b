"""Benchmark passages in documents, through a positional inverted index; DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retort.llm.common import read, stored

WINDOW = 10
#: Terms of a window, rarest in the documents first, whose posting lists are intersected before the text is compared.
RAREST = 2
#: Bytes of a table that may be broadcast, once they are counted. Beyond, Spark shuffles.
BROADCAST_BYTES = 32 << 20
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text with A-Z lower-cased; null has none."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.filter(F.split(F.coalesce(lowered, F.lit("")), _BETWEEN), lambda w: w != "")


def checked_broadcast(df: DataFrame, *measured: Column) -> DataFrame:
    """df, to be broadcast if the measured columns, and 64 bytes a row, are within BROADCAST_BYTES. df should be stored."""
    size = F.sum(sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in measured), F.lit(64)).cast("long"))
    return F.broadcast(df) if (df.agg(size).first()[0] or 0) <= BROADCAST_BYTES else df


def items_of(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """item_id and words of the items that have words."""
    return benchmark.select(F.col(item).alias("item_id"), words_of(F.col(text)).alias("item_words")).filter(F.size("item_words") > 0)


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """term and its occurrences in all documents, for the given terms."""
    tokens = docs.select(F.explode(words_of(F.col("text"))).alias("term"))
    return tokens.join(checked_broadcast(terms, F.col("term")), "term").groupBy("term").agg(F.count("*").alias("n"))


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The positional index: term, document (doc_id and a hash of its text) and position of every occurrence."""
    tokens = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(words_of(F.col("text"))).alias("at", "term"))
    return tokens.join(checked_broadcast(terms, F.col("term")), "term").select("term", "doc_id", "text_hash", "at")


def plan_windows(items: DataFrame, counts: DataFrame, window: int = WINDOW, rarest: int = RAREST) -> DataFrame:
    """item_id, item_words and windows array<struct<start, anchors>>: anchors are the positions of a window's rarest terms.

    Windows with a term that no document has can't occur and are left out.
    """
    keyed = items.withColumn("item_key", F.xxhash64("item_id", "item_words"))
    placed = keyed.select("item_key", F.posexplode("item_words").alias("at", "term")).join(counts, "term", "left")
    found = placed.groupBy("item_key").agg(F.array_sort(F.collect_set(F.struct("at", F.coalesce("n", F.lit(0)).alias("n")))).alias("freq"))
    length = F.least(F.lit(window), F.size("freq"))

    def plan(start: Column) -> Column:
        inside = F.slice("freq", start + 1, length)
        ranked = F.array_sort(F.transform(inside, lambda x: F.struct(x["n"].alias("n"), x["at"].alias("at"))))
        return F.struct(start.alias("start"), ranked[0]["n"].alias("least"), F.transform(F.slice(ranked, 1, rarest), lambda x: x["at"]).alias("anchors"))

    planned = F.filter(F.transform(F.sequence(F.lit(0), F.size("freq") - length), plan), lambda w: w["least"] > 0)
    return keyed.join(found.select("item_key", planned.alias("windows")), "item_key").filter(F.size("windows") > 0)


def intersect(index: DataFrame, planned: DataFrame) -> DataFrame:
    """Documents and alignments at which all anchors of some window stand: doc_id, text_hash, item_key, shift, starts."""
    anchors = planned.select("item_key", "item_words", F.explode(F.array_distinct(F.flatten(F.transform("windows", lambda w: w["anchors"])))).alias("item_at"))
    anchors = anchors.select("item_key", "item_at", F.element_at("item_words", F.col("item_at") + 1).alias("term"))
    # Offset-adjusted: occurrences that belong to one alignment of item and document have one shift.
    met = index.join(anchors, "term").select("doc_id", "text_hash", "item_key", (F.col("at") - F.col("item_at")).alias("shift"), "item_at")
    lists = met.groupBy("doc_id", "text_hash", "item_key", "shift").agg(F.collect_set("item_at").alias("there"))
    whole = F.transform(F.filter("windows", lambda w: (w["start"] + F.col("shift") >= 0) & F.forall(w["anchors"], lambda a: F.array_contains("there", a))), lambda w: w["start"])
    return lists.join(planned.select("item_key", "windows"), "item_key").withColumn("starts", whole).filter(F.size("starts") > 0).drop("windows", "there")


def phrase_matches(docs: DataFrame, benchmark: DataFrame, *keep: str, window: int = WINDOW, rarest: int = RAREST) -> DataFrame:
    """doc_id, the kept columns, n_words and matches array<struct<item_id, shift, starts, length>> of every document.

    A match is an exact occurrence of `length` consecutive words of the item from each of `starts`, at start + shift in
    the document. Null and empty texts have no words and no matches; items of no words are never found; rows that
    repeat an id are separate documents; other columns are ignored.
    """
    keep = tuple(k for k in dict.fromkeys(keep) if k not in ("doc_id", "n_words", "matches"))
    rows, docs = docs, docs.select("doc_id", "text")
    items = stored(items_of(benchmark))
    counts = term_counts(docs, items.select(F.explode("item_words").alias("term")).distinct())
    planned = stored(plan_windows(items, counts, window, rarest))
    wanted = planned.select("item_words", F.explode("windows").alias("w")).select(F.explode(F.transform("w.anchors", lambda a: F.element_at("item_words", a + 1))).alias("term")).distinct()
    index = stored(postings(docs, wanted))
    candidates = intersect(index, planned).join(planned.select("item_key", "item_id", "item_words"), "item_key")
    per_doc = stored(candidates.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("item_id", "item_words", "shift", "starts")).alias("candidates")))
    per_doc = checked_broadcast(per_doc.toDF("__doc", "__of", "__candidates"), F.to_json("__candidates"))
    texts = rows.select("doc_id", *keep, F.col("text").alias("__body"), F.xxhash64("text").alias("__hash"))
    joined = texts.join(per_doc, texts["doc_id"].eqNullSafe(per_doc["__doc"]) & (texts["__hash"] == per_doc["__of"]), "left")
    joined = joined.select("doc_id", *keep, words_of(F.col("__body")).alias("__words"), "__candidates")

    def check(c: Column) -> Column:
        length = F.least(F.lit(window), F.size(c["item_words"]))
        same = lambda s: F.slice("__words", c["shift"] + s + 1, length) == F.slice(c["item_words"], s + 1, length)
        return F.struct(c["item_id"].alias("item_id"), c["shift"].alias("shift"), F.filter(c["starts"], same).alias("starts"), length.alias("length"))

    found = F.filter(F.transform("__candidates", check), lambda m: F.size(m["starts"]) > 0)
    return joined.select("doc_id", *keep, F.size("__words").cast("long").alias("n_words"), F.when(F.col("__candidates").isNotNull(), found).alias("matches"))


def proximity_matches(docs: DataFrame, benchmark: DataFrame, slop: int, window: int = WINDOW) -> DataFrame:
    """doc_id, item_id, start and at: windows whose words all stand within `slop` words of their places, around the
    window's rarest term at `at`; slop 0 gives the exact phrases. Every term of every window is indexed."""
    docs = docs.select("doc_id", "text")
    items = stored(items_of(benchmark))
    index = stored(postings(docs, items.select(F.explode("item_words").alias("term")).distinct()))
    planned = plan_windows(items, index.groupBy("term").agg(F.count("*").alias("n")), window, 1)
    one = planned.select("item_id", "item_words", F.explode("windows").alias("w"))
    one = one.select("item_id", F.col("w.start").alias("start"), F.col("w.anchors")[0].alias("anchor"), F.slice("item_words", F.col("w.start") + 1, window).alias("phrase"))
    one = one.withColumn("term", F.element_at("phrase", F.col("anchor") - F.col("start") + 1))
    begun = index.join(one, "term").select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), "item_id", "start", F.col("at").alias("anchor_at"), "anchor", "phrase")
    need = begun.select("_doc", "_hash", "item_id", "start", "anchor_at", "anchor", F.size("phrase").alias("n"), F.posexplode("phrase").alias("k", "term"))
    near = F.abs(F.col("at") - F.col("anchor_at") - (F.col("start") + F.col("k") - F.col("anchor"))) <= slop
    met = need.join(index, "term").filter(F.col("_doc").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash")) & near)
    keys = ["doc_id", "item_id", "start", "anchor_at"]
    return met.groupBy(*keys, "n").agg(F.count_distinct("k").alias("met")).filter("met = n").select("doc_id", "item_id", "start", F.col("anchor_at").alias("at"))


def hit_words(matches: Column) -> Column:
    """How many words of the document lie in any match."""
    spans = F.transform(matches, lambda m: F.flatten(F.transform(m["starts"], lambda s: F.sequence(m["shift"] + s, m["shift"] + s + m["length"] - 1))))
    return F.coalesce(F.size(F.array_distinct(F.flatten(spans))), F.lit(0)).cast("long")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_matches(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))
    ids = F.coalesce(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"].cast("string")))), F.array().cast("array<string>"))
    n_hit = F.when(F.col("matches").isNull(), F.lit(0).cast("long")).otherwise(hit_words(F.col("matches")))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


_SQL_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP7_SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
iw AS (SELECT item_id, least(len(w), {WINDOW}) AS n, unnest(list_transform(range(0, len(w) - least(len(w), {WINDOW}) + 1), lambda s: list_slice(w, s + 1, s + least(len(w), {WINDOW})))) AS g FROM b WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, unnest(range(0, len(w) - n + 1)) AS s, unnest(list_transform(range(0, len(w) - n + 1), lambda s: list_slice(w, s + 1, s + n))) AS g FROM d, lens WHERE len(w) >= n),
hit AS (SELECT doc_id, s, dw.n AS n, item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.g = iw.g),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS joined FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN ids USING (doc_id)
"""
