"""Invariants: what must hold between results, each as the rows that break it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retort.functions import text as t
from retort.functions import vocab
from retort.functions.metrics import target_cue
from retort.operators.filters import compound_name
from retort.storage import materialize


def first_examples(rows: DataFrame, condition: Column, message: str, order: str, show: str, n: int = 5) -> DataFrame:
    """message and up to n examples of the rows that meet a condition; no row if none does."""
    met = rows.filter(condition).orderBy(order).limit(n)
    return met.agg(F.array_sort(F.collect_list(F.struct(order, show))).alias("e")).filter(F.size("e") > 0).select(F.lit(message).alias("message"), F.array_join(F.transform("e", lambda x: x[show].cast("string")), ", ").alias("examples"))


def retry_messages(reactions: DataFrame) -> DataFrame:
    """What a batch of reactions lacks, by detector: products with a placeholder for a name, sides without names, no outcome at all."""
    r, named = F.col("reaction"), reactions.withColumn("_id", F.col("reaction.id"))
    names = lambda side: F.transform(F.coalesce(r[side], F.array()), compound_name)
    detectors = {
        "placeholder_product": F.exists(names("products"), lambda n: F.lower(t.squeeze(n)).isin(*vocab.INVALID_NAMES)),
        "unnamed_substrate": F.forall(names("substrates"), lambda n: n == ""),
        "unnamed_product": F.forall(names("products"), lambda n: n == ""),
        "no_target": F.coalesce(*[F.nullif(t.clean_text(r["targets"][k]), F.lit("")) for k in ("yield", "ee", "er", "dr")]).isNull(),
    }
    found = None
    for message, condition in detectors.items():
        one = first_examples(named, condition, message, "reaction_pos", "_id")
        found = one if found is None else found.unionByName(one)
    return found


def missed_targets(text: Column, mode: Column, reactions: Column) -> Column:
    """The ids of reactions with products but no outcome, in a chunk of a procedure whose text names outcomes; else null."""
    named = lambda r: F.exists(F.coalesce(r["products"], F.array()), lambda c: F.coalesce(c["name"], F.lit("")) != "")
    silent = lambda r: F.coalesce(*[F.nullif(r["targets"][k], F.lit("")) for k in ("yield", "ee", "er", "dr")]).isNull()
    missed = F.transform(F.filter(reactions, lambda r: named(r) & silent(r)), lambda r: F.coalesce(r["id"], F.lit("<missing id>")))
    return F.when(mode.isin("gp", "mixed") & target_cue(text) & (F.size(missed) > 0), missed)


def preview(items: Column, n: int) -> Column:
    """The first n of an array joined by "; ", and how many more there are; "" for null and for an empty one."""
    more = F.size(items) - n
    return F.coalesce(F.concat(F.array_join(F.slice(items, 1, n), "; "), F.when(more > 0, F.concat(F.lit("; ... (+"), more.cast("string"), F.lit(" more)"))).otherwise("")), F.lit(""))


#: In JSON without nulls: a text that isn't blank, a number, or a truth value, at any depth.
_SAID = r'(?::|\[(?:"(?:\s|\\[nrtf])*+",)*)(?:"(?:\s|\\[nrtf])*+[^"\s]|[-0-9tf])'


def _filled(value: Column) -> Column:
    """Whether a nested value says anything at any depth."""
    return F.coalesce(F.to_json(value).rlike(_SAID), F.lit(False))


def _named(reaction: Column) -> Column:
    return F.coalesce(F.nullif(t.strip(reaction["id"]), F.lit("")), F.lit("<missing id>"))


def empty_substrates(reactions: Column, mode: Column, keys: Column) -> Column:
    """The ids of reactions with products and outcomes but no substrate, where a mixed job was given procedures; else null."""
    bare = F.filter(reactions, lambda r: ~_filled(r["substrates"]) & _filled(r["products"]) & _filled(r["targets"]))
    return F.when((mode == "mixed") & (F.size(keys) > 0) & (F.size(bare) > 0), F.transform(bare, _named))


def foreign_templates(reactions: Column, mode: Column, keys: Column) -> Column:
    """"id: source" of reactions that name a procedure which their job wasn't given; else null."""
    source = lambda r: F.coalesce(t.strip(r["gp_source"]), F.lit(""))
    found = F.filter(reactions, lambda r: (source(r) != "") & ~F.array_contains(keys, source(r)))
    return F.when(mode.isin("gp", "mixed") & (F.size(keys) > 0) & (F.size(found) > 0), F.transform(found, lambda r: F.concat(_named(r), F.lit(": "), source(r))))


def missing_template_fields(reactions: Column, mode: Column, keys: Column, templates: Column) -> Column:
    """"id: fields" of reactions that lack what their template has, or its name; null where nothing lacks.

    templates: map of gp_key to struct<status, template>. In a mixed job only reactions that name a procedure count; one
    without a name takes the only template of its job. A template that isn't valid asks for nothing but the name.
    """
    some = lambda v: F.coalesce(t.strip(v), F.lit("")) != ""

    def lacks(r: Column) -> Column:
        source = t.strip(r["gp_source"])
        key = F.when(some(source) & F.map_contains_key(templates, source), source).when(F.size(keys) == 1, keys[0])
        entry = F.try_element_at(templates, key)
        g, valid = entry["template"], F.coalesce(entry["status"] == "valid", F.lit(False))
        roles = [F.when(valid & _filled(g[k]) & ~_filled(r[k]), F.lit(k)) for k in ("substrates", "catalysts", "ligands", "other_components")]
        told = lambda c: F.map_keys(F.map_filter(F.coalesce(c["conditions"], F.expr("cast(map() as map<string,array<struct<step:int,value:string>>>)")), lambda _, v: _filled(v)))
        conditions = F.transform(F.array_sort(F.array_except(F.when(valid, told(g)).otherwise(F.expr("cast(array() as array<string>)")), told(r))), lambda k: F.concat(F.lit("conditions."), k))
        head = F.array(F.when(~some(source), "_gp_source"), *roles, F.when(valid & _filled(g["intermediates"]) & ~_filled(r["intermediates"]), "intermediates"))
        tail = F.array(F.when(valid & some(g["reaction_type"]) & ~some(r["reaction_type"]), "reaction_type"), F.when(valid & g["step_count"].isNotNull() & ~g["step_count"].eqNullSafe(r["step_count"]), "step_count"))
        return F.array_compact(F.concat(head, conditions, tail))

    counted = F.filter(reactions, lambda r: (mode != "mixed") | some(r["gp_source"]))
    told = F.filter(F.transform(counted, lambda r: F.struct(_named(r).alias("id"), lacks(r).alias("fields"))), lambda x: F.size(x["fields"]) > 0)
    return F.when(mode.isin("gp", "mixed") & (F.size(templates) > 0) & (F.size(told) > 0), F.transform(told, lambda x: F.concat(x["id"], F.lit(": "), F.array_join(x["fields"], ", "))))


def resolution_violations(resolved: DataFrame, ambiguous: DataFrame, scope: Sequence[str], symbol: str = "symbol") -> DataFrame:
    """Rows resolved though they must not be, with the reason: an ambiguous symbol, a name of their own, doubt, a foreign role."""
    bad = ambiguous.select(*scope, symbol).distinct().withColumn("_amb", F.lit(True))
    rows = resolved.join(bad, [*scope, symbol], "left")
    reason = F.when(F.col("_amb"), "ambiguous_symbol").when(t.normalize_symbol(F.col("name")) != t.normalize_symbol(F.col(symbol)), "had_a_name").when(t.is_uncertain(F.col("text")), "uncertain_text").when(~F.col("field").isin("substrates", "products", "catalysts", "ligands"), "not_a_compound")
    return rows.withColumn("violation", reason).filter("violation is not null").drop("_amb")


def compare_roles(now: DataFrame, baseline: DataFrame, key: Sequence[str], role: str = "role") -> DataFrame:
    """key, baseline_role, role and change (same, changed, added, removed) of each condition row on either side."""
    a, b = now.select(*key, role, F.lit(True).alias("_now")), baseline.select(*key, F.col(role).alias("baseline_role"), F.lit(True).alias("_then"))
    change = F.when(F.col("_then").isNull(), "added").when(F.col("_now").isNull(), "removed").when(F.col(role).eqNullSafe(F.col("baseline_role")), "same").otherwise("changed")
    return a.join(b, list(key), "full_outer").select(*key, "baseline_role", role, change.alias("change"))


def rebind(inputs: DataFrame, files: DataFrame, path: str = "path") -> DataFrame:
    """inputs with the file of the same base name, null where there is none: a rebind is whole if no null is left."""
    base = lambda c: F.element_at(F.split(c, r"[/\\]"), -1)
    known = files.select(base(F.col(path)).alias("_base"), F.col(path).alias("file")).groupBy("_base").agg(F.min("file").alias("file"))
    return inputs.withColumn("_base", base(F.col(path))).join(known, "_base", "left").drop("_base")


def count_mismatches(stored: DataFrame, actual: DataFrame, key: str, n: str = "n_options") -> DataFrame:
    """Ids whose stored count isn't the number of their options, on either side."""
    counted = actual.groupBy(key).agg(F.count("*").alias("actual"))
    return stored.select(key, F.col(n).alias("stored")).join(counted, key, "full_outer").filter(~F.col("stored").eqNullSafe(F.col("actual")))


def coverage(expected: Column, seen: Column) -> Column:
    """struct<missing, unexpected> of two arrays."""
    return F.struct(F.array_sort(F.array_except(expected, seen)).alias("missing"), F.array_sort(F.array_except(seen, expected)).alias("unexpected"))


def accept_identities(rows: DataFrame) -> DataFrame:
    """rows (reported, proposed, products array, evidence, source_pages, allowed_pages) with `reject`: why a proposed name of
    a generic substrate isn't taken, or null."""
    p, reported = t.clean_text(F.col("proposed")), t.clean_text(F.col("reported"))
    reject = (
        F.when(p == "", "empty_name")
        .when(F.lower(p).isin(*vocab.GENERIC_NAMES), "generic_name")
        .when(F.lower(p) == F.lower(reported), "unchanged")
        .when(t.looks_like_symbol(p), "symbol_only")
        .when(F.array_contains(F.transform("products", F.lower), F.lower(p)), "is_a_product")
        .when(t.clean_text(F.col("evidence")) == "", "no_evidence")
        .when(t.is_uncertain(F.col("evidence")), "uncertain_evidence")
        .when(F.coalesce(F.size("source_pages"), F.lit(0)) <= 0, "no_pages")
        .when(F.size(F.array_except("source_pages", "allowed_pages")) > 0, "foreign_pages")
    )
    return rows.withColumn("reject", reject)


def reusable(outputs: DataFrame, inputs: DataFrame, key: str) -> DataFrame:
    """key and reuse: whether an output (metadata map, is_partial, input_sha256) was made whole from just this input."""
    known = outputs.select(key, F.col("metadata").alias("_m"), "is_partial", F.col("input_sha256").alias("_h"))
    joined = inputs.join(known, key, "left")
    same = F.size(F.array_except(F.map_entries("metadata"), F.map_entries("_m"))) == 0
    return joined.select(key, F.coalesce(same & ~F.col("is_partial") & (F.col("_h") == F.col("input_sha256")), F.lit(False)).alias("reuse"))


def changed_outcomes(before: DataFrame, after: DataFrame, *columns: str) -> DataFrame:
    """Rows of outcomes that a backfill without models has changed or lost; it must leave none."""
    return before.select(*columns).exceptAll(after.select(*columns))


def scaffold_class(products: Column) -> Column:
    """"<scaffold> product" if the products have just one scaffold, else null."""
    found = F.array_distinct(F.filter(F.transform(products, lambda c: t.clean_text(c["scaffold"])), lambda s: ~s.isin("", "unknown")))
    return F.when(F.size(found) == 1, F.concat(found[0], F.lit(" product")))


def specific_products(products: Column) -> Column:
    """The positions of products with a concrete name."""
    placed = F.transform(products, lambda c, i: F.struct(i.alias("i"), compound_name(c).alias("n")))
    return F.transform(F.filter(placed, lambda x: (x["n"] != "") & ~F.lower(x["n"]).isin(*vocab.INVALID_NAMES, *vocab.GENERIC_NAMES) & ~t.looks_like_symbol(x["n"])), lambda x: x["i"])


def fan_out(reactions: DataFrame, modalities: Sequence[str], objectives: Sequence[str]) -> DataFrame:
    """reactions once for each objective, those of the named modalities: one pass makes all packages."""
    return reactions.filter(F.col("source_modality").isin(*modalities)).withColumn("objective", F.explode(F.array(*[F.lit(o) for o in objectives])))


def hidden_symbols(compounds: Column) -> Column:
    """Sorted "name=symbol" of the compounds that have a symbol, kept out of what a question shows."""
    return F.array_sort(F.transform(F.filter(compounds, lambda c: t.clean_text(c["symbol"]) != ""), lambda c: F.concat(t.clean_text(c["name"]), F.lit("="), t.clean_text(c["symbol"]))))


def covered_by_context(row_text: Column, labels: Column) -> Column:
    """Whether a reagent row says nothing new: it is a list, or a label of its context holds it."""
    text = F.lower(t.clean_text(row_text))
    return text.rlike("[;,]") | F.exists(labels, lambda x: F.contains(F.lower(t.clean_text(x)), text) & (text != ""))


def router_jobs(routes: DataFrame, known: Sequence[str] = ("text", "image", "both", "skip")) -> DataFrame:
    """Jobs with a known route, lower-cased; the others are dropped."""
    route = F.lower(t.strip(F.col("route")))
    return routes.withColumn("route", route).filter(F.col("route").isin(*known) & (t.clean_text(F.col("paper_key")) != ""))


#: Items of sets whose subsets are always listed, and of those that may be.
LISTED, LISTED_AT_MOST = 10, 20
#: Subsets that a task lists.
SUBSETS = 1 << 21


def _set_id(items: Column, *names: str) -> list[Column]:
    """Two hashes of sorted items, 128 bits together."""
    return [F.xxhash64(items).alias(names[0]), F.xxhash64(F.lit(1), items).alias(names[1])]


def _different_sets(sets: DataFrame, key: str, item: str) -> tuple[DataFrame, DataFrame]:
    """(key, a, b of every key with items; a, b, items and n of each different set), both stored."""
    whole = sets.filter(F.col(item).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_set(item)).alias("items"))
    keyed = materialize(whole.select(key, *_set_id(F.col("items"), "a", "b"), "items"))
    return keyed.drop("items"), materialize(keyed.groupBy("a", "b").agg(F.any_value("items").alias("items")).withColumn("n", F.size("items")))


def _met_sets(distinct: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, b, c, d: the proper subsets a, b of sets c, d, whether there are such sets or not; a, b, c, d of the sets c, d whose
    subsets aren't listed, and the sets that they hold).

    A set of n items has 2^n subsets. One of more than LISTED lists them only if that is less than the sets that it would be
    compared with: those whose rarest item (the least of several) it has.
    """
    listed, rest = distinct.filter(F.col("n").between(2, LISTED)), None
    wide = distinct.filter(F.col("n") > LISTED)
    if wide.limit(1).count():
        posted = distinct.select("a", "b", F.explode("items").alias("item"))
        counts = posted.groupBy("item").agg(F.count("*").alias("c"))
        rarest = posted.join(counts, "item").groupBy("a", "b").agg(F.min(F.struct("c", "item"))["item"].alias("item"))
        firsts = materialize(rarest.join(distinct, ["a", "b"]))
        reach = firsts.groupBy("item").agg(F.count("*").alias("reach"))
        met = wide.select("a", "b", F.explode("items").alias("item")).join(reach, "item", "left").groupBy("a", "b").agg(F.sum("reach").alias("reach"))
        wide = materialize(wide.join(met, ["a", "b"]).withColumn("few", (F.col("n") <= LISTED_AT_MOST) & (F.pow(F.lit(2.0), F.col("n")) <= F.col("reach"))))
        listed = listed.unionByName(wide.filter("few").select(*listed.columns))
        large = wide.filter("not few").select(F.col("a").alias("c"), F.col("b").alias("d"), F.col("items").alias("_large"), F.col("n").alias("_n"), F.explode("items").alias("item"))
        rest = firsts.join(large, "item").filter((F.col("n") < F.col("_n")) & (F.size(F.array_except("items", "_large")) == 0)).select("a", "b", "c", "d")
    else:
        rest = distinct.limit(0).select("a", "b", F.col("a").alias("c"), F.col("b").alias("d"))
    some = listed.agg(F.coalesce(F.sum(F.pow(F.lit(2.0), F.col("n"))), F.lit(0.0))).first()[0]
    masks = F.sequence(F.lit(1).cast("long"), F.pow(F.lit(2.0), F.col("n")).cast("long") - 2)
    each = listed.repartition(1 + int(some) // SUBSETS).select(F.col("a").alias("c"), F.col("b").alias("d"), "items", F.explode(masks).alias("mask"))
    part = F.filter("items", lambda x, i: F.getbit(F.col("mask"), i) == 1)
    return each.select("c", "d", part.alias("part")).select(*_set_id(F.col("part"), "a", "b"), "c", "d"), rest


def contained_sets(sets: DataFrame, key: str, item: str) -> tuple[DataFrame, DataFrame]:
    """(pairs of set_id, within: each different set and each different, larger one that holds it; members: key, set_id).

    sets: rows of a key and an item; repeated and null items don't count, and a key without items is in no set. Keys with
    equal items share a set, so that copies never meet. Sets are found by the subsets of larger ones: most have few items,
    and so the work grows with their number. A set with too many subsets is compared item by item with those whose rarest
    item it has. A set must fit in a row.
    """
    keyed, distinct = _different_sets(sets, key, item)
    subsets, rest = _met_sets(distinct)
    pairs = subsets.join(distinct.select("a", "b"), ["a", "b"]).unionByName(rest)
    return pairs.select(F.struct("a", "b").alias("set_id"), F.struct(F.col("c").alias("a"), F.col("d").alias("b")).alias("within")), keyed.select(key, F.struct("a", "b").alias("set_id"))


def held_by(sets: DataFrame, key: str, item: str) -> DataFrame:
    """key and held_by of every key with items: in how many different, larger sets its own lies, of the pairs that
    contained_sets() gives; they are counted where they are found, and so aren't laid out."""
    keyed, distinct = _different_sets(sets, key, item)
    subsets, rest = _met_sets(distinct)
    counts = subsets.groupBy("a", "b").agg(F.count("*").alias("held_by"))
    counts = counts.unionByName(rest.groupBy("a", "b").agg(F.count("*").alias("held_by")))
    counts = counts.join(distinct.select("a", "b"), ["a", "b"], "left_semi").groupBy("a", "b").agg(F.sum("held_by").alias("held_by"))
    return keyed.join(counts, ["a", "b"], "left").select(key, F.coalesce("held_by", F.lit(0)).cast("long").alias("held_by"))


def leaked_questions(questions: DataFrame, answers: DataFrame, key: str = "question_id", text: str = "question_text") -> DataFrame:
    """key and answer of the questions whose shown text holds one of their own gold answers as whole words, case aside.

    answers: key, answer. Each question meets only its own answers; empty answers leak nothing.
    """
    fold = lambda c: F.concat(F.lit(" "), F.btrim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    own = answers.select(key, "answer").distinct().filter(F.btrim(fold(F.col("answer"))) != "")
    return questions.join(own, key).filter(F.contains(fold(F.coalesce(text, F.lit(""))), fold(F.col("answer")))).select(key, "answer")
