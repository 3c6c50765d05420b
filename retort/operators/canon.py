"""Bringing reactions into one shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retort.functions import metrics as m
from retort.functions import text as t
from retort.functions import vocab


def lift_targets(targets: Column, top: Column) -> Column:
    """Outcomes given beside `targets` go into it where it has none; empty ones become null, and the struct if all are."""
    pick = lambda k: F.coalesce(F.when(~t.one_of(targets[k], vocab.MERGE_EMPTY), targets[k]), F.when(~t.one_of(top[k], vocab.MERGE_EMPTY), top[k]))
    names = ("yield", "ee", "er", "dr")
    return F.when(F.coalesce(*[pick(k) for k in names]).isNotNull(), F.struct(*[pick(k).alias(k) for k in names]))


def derive_ee(targets: Column) -> tuple[Column, Column]:
    """(targets with an excess from the ratio where none is given, status of the conversion); null targets have no status."""
    converted = m.convert_er(targets["ee"], targets["er"])
    out = F.struct(targets["yield"].alias("yield"), converted["ee"].alias("ee"), converted["er"].alias("er"), targets["dr"].alias("dr"))
    return F.when(targets.isNotNull(), out), F.when(targets.isNotNull(), converted["status"])


def clean_targets(targets: Column) -> Column:
    """Outcomes without empty words, without brackets around them and without a ratio's own name."""
    plain = lambda k: F.when(~t.one_of(targets[k], vocab.METRIC_EMPTY), m.peel_parentheses(t.strip(targets[k])))
    return F.struct(plain("yield").alias("yield"), plain("ee").alias("ee"), m.clean_ratio(targets["er"], "er").alias("er"), m.clean_ratio(targets["dr"], "dr").alias("dr"))


def step_count(reaction: Column, roles: tuple[str, ...]) -> Column:
    """The largest step that the reaction, its compounds, conditions or intermediates name; null if none."""
    steps = [F.transform(F.coalesce(reaction[r], F.array()), lambda c: c["step"]) for r in roles]
    steps.append(F.transform(F.coalesce(F.flatten(F.map_values(reaction["conditions"])), F.array()), lambda v: v["step"]))
    steps.append(F.flatten(F.transform(F.coalesce(reaction["intermediates"], F.array()), lambda i: F.array(i["produced_in_step"], i["consumed_in_step"]))))
    return F.array_max(F.concat(F.array(reaction["step_count"]), *steps))


def step_error(reaction: Column, count: Column) -> Column:
    """What is wrong with a multi-step reaction's intermediates, or null."""
    some = F.coalesce(reaction["intermediates"], F.array())
    keys = F.transform(some, lambda i: t.normalize_symbol(t.first_text(i["symbol"], i["name"])))
    return (
        F.when(F.exists(some, lambda i: i["produced_in_step"] >= i["consumed_in_step"]), "produced_not_before_consumed")
        .when(F.exists(some, lambda i: i["consumed_in_step"] > count), "consumed_after_last_step")
        .when(F.size(F.array_distinct(keys)) < F.size(keys), "repeated_intermediate")
    )


def single_step(conditions: Column) -> Column:
    """Conditions of one step: each key's values joined by "; ", without a step."""
    joined = lambda v: F.array_join(F.array_distinct(F.transform(v, lambda x: t.squeeze(x["value"]))), "; ")
    return F.transform_values(conditions, lambda _, v: F.array(F.struct(F.lit(None).cast("int").alias("step"), joined(v).alias("value"))))


def condition_amounts(conditions: Column) -> Column:
    """`volume` becomes `solvent_amount` unless that is there; an empty concentration goes."""
    moved = F.map_concat(
        F.map_filter(conditions, lambda k, _: k != "volume"),
        F.map_from_entries(F.filter(F.array(F.struct(F.lit("solvent_amount").alias("key"), F.try_element_at(conditions, F.lit("volume")).alias("value"))), lambda e: e["value"].isNotNull() & ~F.map_contains_key(conditions, "solvent_amount"))),
    )
    return F.map_filter(moved, lambda k, v: (k != "concentration") | F.exists(v, lambda x: t.clean_text(x["value"]) != ""))


def merge_same_compounds(rows: DataFrame, key: list[str], name: str, step: str, amount: str, pos: str) -> DataFrame:
    """One row for each (key, name, step), in the order of first mention, its different amounts joined by "; "."""
    amounts = F.transform(F.array_sort(F.collect_list(F.struct(pos, amount))), lambda x: t.clean_text(x[amount]))
    joined = F.array_join(F.array_distinct(F.filter(amounts, lambda a: a != "")), "; ")
    return rows.groupBy(*key, name, step).agg(joined.alias(amount), F.min(pos).alias(pos))


def inheritance(fields: dict[str, Column]) -> Column:
    """struct<reasons, score>: which of the named fields say something, and how many."""
    reasons = F.array_compact(F.array(*[F.when(filled, F.lit(name)) for name, filled in fields.items()]))
    return F.struct(reasons.alias("reasons"), F.size(reasons).alias("score"))


def route_conditions(records: DataFrame, key: list[str], conditions: str = "conditions") -> DataFrame:
    """key, target (where a record's condition row goes: catalysts, additives, reagents, conditions.x, targets.x), value.

    Ligands of images are filed under catalysts. Rows are told by their refined role unless it is unknown.
    """
    rows = records.select(*key, F.posexplode(conditions).alias("item_pos", "c"))
    role = t.direct_role(t.effective_role(F.col("c.refined_role"), F.coalesce("c.original_role", "c.role")))
    target = (
        F.when(role.isin("catalyst", "ligand"), "catalysts")
        .when(role.isin("additive", "base"), "additives")
        .when(role.isin("yield", "ee", "er", "dr"), F.concat(F.lit("targets."), role))
        .when(role.isin("solvent", "temperature", "time", "concentration", "volume", "atmosphere", "light", "wavelength"), F.concat(F.lit("conditions."), role))
        .otherwise("reagents")
    )
    return rows.select(*key, "item_pos", target.alias("target"), t.first_text(F.col("c.text"), F.col("c.label"), F.col("c.iupac_name"), F.col("c.smiles")).alias("value"))


def nested_paths(rows: DataFrame, key: str, variant: str, name: str) -> DataFrame:
    """key, path and value of every object field `name` at any depth of a VARIANT.

    Each level is one explode of the objects and arrays that the level above left, until a level leaves none.
    """
    level = rows.select(key, F.lit("$").alias("path"), F.col(variant).alias("value"))
    found = None
    while found is None or level.limit(1).count():
        # children that hold others: an object's or array's text begins so
        children = level.sparkSession.sql("SELECT l.k, concat(l.path, coalesce('.' || e.key, '[' || e.pos || ']')) AS path, e.key AS field, e.value FROM {level} l, LATERAL variant_explode(l.value) e", level=level.withColumnRenamed(key, "k")).withColumnRenamed("k", key)
        hit = children.filter(F.col("field") == name).select(key, "path", "value")
        found = hit if found is None else found.unionByName(hit)
        level = children.filter(F.to_json("value").rlike(r"\A[{\[]")).select(key, "path", "value")
    return found


def legacy_reaction(reaction: Column, position: Column) -> Column:
    """struct<id, conditions, targets and the roles> of a reaction of the older form, with nothing null: an id by position,
    empty maps and arrays."""
    roles = ("substrates", "products", "catalysts", "ligands", "other_components", "additives", "reagents")
    return F.struct(
        F.coalesce(reaction["id"], F.concat(F.lit("reaction_"), position.cast("string"))).alias("id"),
        F.coalesce(reaction["conditions"], F.create_map().cast("map<string,array<struct<step:int,value:string>>>")).alias("conditions"),
        F.coalesce(reaction["targets"], F.struct(*[F.lit(None).cast("string").alias(k) for k in ("yield", "ee", "er", "dr")])).alias("targets"),
        *[F.coalesce(reaction[r], F.array()).alias(r) for r in roles],
    )


def append_unique(have: Column, new: Column) -> Column:
    """An array of structs with those of another after it that are named and not there yet, as they stand in JSON."""
    return F.concat(have, F.filter(F.array_distinct(F.filter(new, lambda c: F.coalesce(c["name"], F.lit("")) != "")), lambda c: ~F.exists(have, lambda h: F.to_json(h) == F.to_json(c))))


def free_condition(text: Column, targets: Column, conditions: Column) -> Column:
    """struct<targets, conditions> with what a free text says of outcomes, solvent, temperature and time where nothing is
    given yet."""
    said = t.clean_text(text)
    outcome = lambda k: F.coalesce(targets[k], F.nullif(m.extract_metric(said, k), F.lit(""))).alias(k)
    found = (("solvent", m.labelled_value(said, "solvent")), ("temperature", m.extract_temperature(said)), ("time", m.extract_time(said)))
    entries = F.filter(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in found]), lambda e: (F.coalesce(e["value"], F.lit("")) != "") & ~F.map_contains_key(conditions, e["key"]))
    return F.struct(F.struct(*[outcome(k) for k in ("yield", "ee", "er", "dr")]).alias("targets"), F.map_concat(conditions, F.map_from_entries(entries)).alias("conditions"))


def digest(reaction: Column, limit: int = 8) -> Column:
    """What a provider is shown of a reaction: up to `limit` names of each role, and what conditions and outcomes say."""
    names = lambda f: F.slice(F.filter(F.transform(F.coalesce(reaction[f], F.array()), lambda c: F.coalesce(F.nullif(c["name"], F.lit("")), c["symbol"])), lambda n: F.coalesce(n, F.lit("")) != ""), 1, limit)
    said = lambda v: ~F.coalesce(v, F.lit("")).isin("", "null")
    conditions = F.map_filter(F.transform_values(reaction["conditions"], lambda _, v: F.array_join(F.transform(v, lambda x: x["value"]), "; ")), lambda _, v: said(v))
    return F.struct(
        *[names(f).alias(f) for f in ("substrates", "products", "intermediates", "catalysts", "ligands", "other_components")],
        conditions.alias("conditions"),
        F.struct(*[F.when(said(reaction["targets"][k]), reaction["targets"][k]).alias(k) for k in ("yield", "ee", "er", "dr")]).alias("targets"),
        reaction["step_count"].alias("step_count"),
        reaction["reaction_type"].alias("raw_reaction_type"),
    )
