"""Filters that label what they reject."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retort.functions import metrics as m
from retort.functions import text as t
from retort.functions import vocab


def compound_name(c: Column) -> Column:
    """The first usable of a compound's names, resolved ones included."""
    usable = lambda v: F.when(~t.one_of(v, vocab.FILTER_NAME_EMPTY), t.strip(v))
    return F.coalesce(*[usable(c[k]) for k in ("iupac_name", "resolved_iupac_name", "name", "resolved_name_normalized", "resolved_name", "smiles", "resolved_smiles", "symbol")], F.lit(""))


def names_of(compounds: Column) -> Column:
    return F.filter(F.transform(compounds, compound_name), lambda n: n != "")


def basic_reason(left: Column, right: Column) -> Column:
    """Why two sides of names (and the sides themselves) make no reaction: the first rule that fails, or null."""
    size = lambda a: F.coalesce(F.size(a), F.lit(0))
    names = lambda a: F.filter(a, lambda n: F.coalesce(n, F.lit("")) != "")
    lower = lambda a: F.array_sort(F.array_distinct(F.transform(names(a), F.lower)))
    invalid = lambda a: F.exists(names(a), lambda n: F.lower(t.squeeze(n)).isin(*vocab.INVALID_NAMES))
    return (
        F.when((size(left) <= 0) | (size(right) <= 0), "empty_side")
        .when((size(names(left)) == 0) | (size(names(right)) == 0), "no_names")
        .when(lower(left) == lower(right), "same_names")
        .when(invalid(left) | invalid(right), "invalid_name")
    )


def label_reactions(reactions: DataFrame) -> DataFrame:
    """reactions (rows with a struct `reaction`) and `reason`: a basic rule, `target`, or null for those that stay."""
    r, target = F.col("reaction"), F.col("reaction.targets")
    named = reactions.withColumns({"_left": F.transform(r["substrates"], compound_name), "_right": F.transform(r["products"], compound_name)})
    passes = m.target_passes(*[F.col(f"reaction.targets.{k}") for k in ("yield", "ee", "er", "dr")])
    basic = basic_reason(F.col("_left"), F.col("_right"))
    return named.withColumn("reason", F.coalesce(basic, F.when(target.isNull() | ~passes, "target"))).drop("_left", "_right")


def filter_stats(labelled: DataFrame, *by: str) -> DataFrame:
    """How many rows came in, failed a basic rule, failed the target rule and stayed."""
    return labelled.groupBy(*by).agg(
        F.count("*").alias("input"),
        F.count_if(F.col("reason").isNotNull() & (F.col("reason") != "target")).alias("basic_failed"),
        F.count_if(F.col("reason") == "target").alias("target_failed"),
        F.count_if(F.col("reason").isNull()).alias("retained"),
    )


def kept(labelled: DataFrame) -> DataFrame:
    return labelled.filter("reason is null").drop("reason")


def has_valid_condition(conditions: Column) -> Column:
    """Whether any value of a condition map says something."""
    return F.exists(F.flatten(F.map_values(conditions)), lambda v: ~t.one_of(v["value"], vocab.CONDITION_EMPTY))


def reaction_type(value: Column) -> Column:
    return F.when(t.one_of(value, vocab.REACTION_TYPE_EMPTY), F.lit(vocab.UNKNOWN_REACTION)).otherwise(t.strip(value))


def modality(value: Column) -> Column:
    """`text` or `image`; null for a name that is neither."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in vocab.MODALITIES.items() for x in pair]), F.lower(t.strip(value)))


def unknown_modalities(rows: DataFrame, column: str) -> DataFrame:
    """The names that modality() doesn't know, sorted: an assertion that holds if this is empty."""
    return rows.filter(modality(F.col(column)).isNull()).select(F.col(column).alias("modality")).distinct().orderBy("modality")


def registry_reason(symbol: Column, name: Column) -> Column:
    """Why an entry of a name registry is useless, or null."""
    text = F.lower(t.clean_text(name))
    return (
        F.when(text == "", "empty")
        .when(text.isin(*vocab.GENERIC_NAMES), "generic")
        .when(t.normalize_symbol(name) == t.normalize_symbol(symbol), "name_is_symbol")
        .when(text.rlike(r"\A(?:compound|substrate|product|ligand|catalyst|reagent|additive|base)s?\s+[a-z]?\d+[a-z]?\z"), "descriptor_and_label")
        .when((F.char_length(text) < 15) & text.rlike(r"\A(?:ligand|catalyst|product|substrate)\b"), "short_descriptor")
    )


def broken_formulas(texts: DataFrame, *keep: str, column: str = "text") -> DataFrame:
    """The kept columns, line_no, pattern and match of every hit of a pattern of lost subscripts, line by line."""
    lines = texts.select(*keep, F.posexplode(F.split(column, r"\r?\n")).alias("line_no", "line"))
    named = lambda name, found: F.transform(found, lambda x: F.struct(F.lit(name).alias("pattern"), x.alias("match")))
    hits = F.flatten(F.array(*[named(n, F.regexp_extract_all("line", F.lit(f"(?i)({p})"), 1)) for n, p in vocab.BROKEN_FORMULAS.items()]))
    return lines.select(*keep, (F.col("line_no") + 1).alias("line_no"), F.inline(hits))


def checkable(text: Column) -> Column:
    """Whether a page isn't one of spectra or crystal data, whose text makes formulas up."""
    return ~F.coalesce(text, F.lit("")).rlike(vocab.ANALYTICAL_PAGE)


def missing_formulas(pages: DataFrame, reference: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """keys and formula: formulas of a page's reference text that its own text lacks, white space aside; pages of spectra or
    crystal data are left out."""
    both = pages.select(*keys, F.col(text).alias("_own")).join(reference.select(*keys, F.col(text).alias("_ref")), list(keys))
    both = both.filter(checkable(F.concat_ws("\n", "_own", "_ref")))
    asked = both.select(*keys, F.regexp_replace(F.coalesce("_own", F.lit("")), r"\s+", "").alias("_own"), F.explode(t.formula_candidates(F.col("_ref"))).alias("formula"))
    return asked.filter(~F.contains("_own", "formula")).drop("_own")


def violations(rows: DataFrame, key: str, options: str, gold: str) -> DataFrame:
    """key and violation of a question bundle: repeated ids, gold that isn't an option, no gold at all."""
    repeated = rows.groupBy(key).count().filter("count > 1").select(key, F.lit("repeated_id").alias("violation"))
    stray = rows.filter(F.size(F.array_except(gold, options)) > 0).select(key, F.lit("gold_not_an_option").alias("violation"))
    none = rows.filter(F.coalesce(F.size(gold), F.lit(0)) <= 0).select(key, F.lit("no_gold").alias("violation"))
    return repeated.union(stray).union(none)
