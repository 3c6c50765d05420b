"""Ranked question sets: grouping, guards with a reason, conflicts, scores, ranks and tied best answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retort.functions import metrics as m
from retort.functions import text as t
from retort.functions import vocab
from retort.operators.filters import reaction_type
from retort.storage import materialize


def staged_reason(*stages: tuple[Column, str]) -> Column:
    """The reason of the first stage whose condition holds, or null."""
    out = None
    for condition, reason in stages:
        out = F.when(condition, reason) if out is None else out.when(condition, reason)
    return out


def build(
    options: DataFrame,
    group: Sequence[str],
    public: Sequence[str],
    outcome: Sequence[str],
    rankable: Column,
    value: Column,
    tie: str,
    eligible: Column | None = None,
    scored: Column | None = None,
    between: Column | None = None,
    few: str = "insufficient_distinct_conditions",
    clashing: str = "duplicate_public_conditions_conflicting_results",
) -> tuple[DataFrame, DataFrame]:
    """(questions, review) of options, by one aggregate to public options and one to groups.

    Options with equal `public` columns are one if their `outcome` columns agree, and vanish to review if not. A group is
    a question if, stage by stage, at least two options are eligible, these have one value of `between` (if given), two
    are scored, two differ in public (else `few`), and one can be ranked. Options that clash are reviewed under `clashing`,
    those of groups that get so far. Options rank by rankable, value (descending) and `tie` as text; all best ones are gold.
    questions: group, n_options, best, gold (sorted array), ranked (array), top3. review: group, reason, n.
    """
    eligible = F.lit(True) if eligible is None else eligible
    scored = F.lit(True) if scored is None else scored
    between = F.lit(None).cast("string") if between is None else between
    flagged = options.withColumns({"_e": eligible, "_s": eligible & scored, "_r": rankable, "_v": value, "_b": between})
    apart = ~F.min(F.when(F.col("_e"), F.col("_b"))).eqNullSafe(F.max(F.when(F.col("_e"), F.col("_b"))))
    sizes = flagged.groupBy(*group).agg(F.count("*").alias("n"), F.count_if("_e").alias("n_eligible"), F.count_if("_s").alias("n_scored"), apart.alias("apart"))
    merged = flagged.filter("_s").groupBy(*group, *public).agg(F.count_distinct(F.struct(*outcome)).alias("_outcomes"), F.count("*").alias("_n"), F.min(F.struct(F.col(tie).cast("string").alias("k"), F.col("_r"), F.col("_v"))).alias("_o"))
    option = F.struct((~F.col("_o._r")).alias("late"), (-F.col("_o._v")).alias("down"), F.col("_o.k").alias("k"))
    best = F.max(F.when(F.col("_o._r"), F.col("_o._v")))
    per_group = merged.filter("_outcomes = 1").groupBy(*group).agg(F.count("*").alias("n_options"), F.count_if("_o._r").alias("n_rankable"), best.alias("best"), F.array_sort(F.collect_list(option)).alias("_options"))
    joined = sizes.join(per_group, list(group), "left").na.fill(0, ["n_options", "n_rankable"])
    reason = staged_reason(
        (F.col("n_eligible") < 2, "insufficient_objective_options"),
        (F.col("apart"), "fixed_substrate_mismatch"),
        (F.col("n_scored") < 2, "insufficient_scored_options"),
        (F.col("n_options") < 2, few),
        (F.col("n_rankable") == 0, "no_rankable_yield_or_ee"),
    )
    labelled = joined.withColumn("reason", reason)
    gold = F.array_sort(F.transform(F.filter("_options", lambda o: ~o["late"] & (o["down"] == -F.col("best"))), lambda o: o["k"]))
    questions = labelled.filter("reason is null").select(*group, "n_options", "best", gold.alias("gold"), F.transform("_options", lambda o: o["k"]).alias("ranked"), (F.col("n_options") >= 3).alias("top3"))
    review = labelled.filter("reason is not null").select(*group, "reason", F.col("n").alias("n"))
    reached = sizes.filter("n_eligible >= 2 and n_scored >= 2 and not apart").select(*group)
    conflicts = merged.filter("_outcomes > 1").join(reached, list(group), "left_semi").select(*group, F.lit(clashing).alias("reason"), F.col("_n").alias("n"))
    return questions, review.unionByName(conflicts)


def rank_options(options: DataFrame, group: Sequence[str], rankable: Column, value: Column, tie: str) -> DataFrame:
    """options with `rank` (1, 2, ...; ties broken by `tie` as text, so "10" comes before "2") and `is_gold`."""
    top = Window.partitionBy(*group)
    w = top.orderBy(F.col("_r").desc(), F.col("_v").desc(), F.col(tie).cast("string"))
    out = options.withColumns({"_r": rankable, "_v": value}).withColumn("rank", F.row_number().over(w))
    gold = F.col("_r") & (F.col("_v") == F.max(F.when(F.col("_r"), F.col("_v"))).over(top))
    return out.withColumn("is_gold", F.coalesce(gold, F.lit(False))).drop("_r", "_v")


def shuffled(options: DataFrame, group: Sequence[str], key: Column, seed: str) -> DataFrame:
    """options with `option_id` O1, O2, ... in an order that only the seed, group and key decide."""
    order = F.sha2(F.concat_ws("|", F.lit(seed), *[F.col(g).cast("string") for g in group], key.cast("string")), 256)
    return options.withColumn("option_id", F.concat(F.lit("O"), F.row_number().over(Window.partitionBy(*group).orderBy(order, key))))


def numbered(questions: DataFrame, order: Sequence[str], prefix: str) -> DataFrame:
    """`id`: prefix_0001, ... by the order of all questions.

    Rows are dealt to tasks by ranges of the order; a row's number is its place in its range and the sizes of the ranges
    before, one number for each task. Equal rows, by the order columns, lie in one range.
    """
    ranged = materialize(questions.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    task = F.shiftright("_at", 33)
    before = ranged.groupBy(task.alias("_task")).agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = ranged.withColumn("_task", task).join(F.broadcast(before), "_task")
    number = (F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).cast("string")
    return placed.withColumn("id", F.concat(F.lit(f"{prefix}_"), F.lpad(number, F.greatest(F.lit(4), F.char_length(number)), F.lit("0")))).select(*questions.columns, "id")


def named_scaffold(compounds: Column) -> Column:
    return F.array_join(F.transform(compounds, lambda c: F.concat(F.coalesce(c["name"], F.lit("")), F.lit(" (scaffold: "), F.coalesce(F.nullif(c["scaffold"], F.lit("")), F.lit("unknown")), F.lit(")"))), "; ")


def question_text(kind: Column, substrates: Column, products: Column, objective: str = m.COMBINED) -> Column:
    """What a condition question asks, line by line; the line of the reaction's type is there if it has one."""
    best = {m.COMBINED: "best combined ee and yield?", m.YIELD_ONLY: "best reported yield?"}[objective]
    lines = [
        F.when(F.coalesce(kind, F.lit("")) != "", F.concat(F.lit("Reaction type: "), kind, F.lit("."))),
        F.concat(F.lit("Substrate combination: "), named_scaffold(substrates), F.lit(".")),
        F.concat(F.lit("Product(s): "), named_scaffold(products), F.lit(".")),
        F.lit("Question: Which complete reaction conditions, including catalyst if applicable, are expected to give the " + best),
    ]
    return F.array_join(F.array_compact(F.array(*lines)), "\n")


def option_counts(questions: DataFrame, *by: str) -> DataFrame:
    """How many options questions have: their number, least, most, and the distribution as an array of <n_options, n>."""
    each = questions.groupBy(*by, "n_options").agg(F.count("*").alias("n"))
    return each.groupBy(*by).agg(F.sum("n").alias("n_questions"), F.min("n_options").alias("least"), F.max("n_options").alias("most"), F.array_sort(F.collect_list(F.struct("n_options", "n"))).alias("distribution"))


def _parts(cs: Column, *fields: tuple[str, str | None]) -> Column:
    """The named components, each as its fields joined, sorted; a field with a mode is folded for grouping."""
    of = lambda c, f, mode: F.coalesce(c[f].cast("string"), F.lit("")) if mode is None else t.grouping_text(c[f].cast("string"), mode)
    named = F.filter(F.coalesce(cs, F.array()), lambda c: ~t.one_of(c["name"], vocab.CONDITION_EMPTY))
    return F.array_sort(F.transform(named, lambda c: F.concat_ws("|", *[of(c, f, mode) for f, mode in fields])))


def _said(conditions: Column, shape) -> Column:
    """`key=value@step,...` of the conditions that say something, by key."""
    told = F.transform(F.coalesce(F.map_entries(conditions), F.array()), lambda e: F.struct(e["key"].alias("key"), F.filter(e["value"], lambda v: t.strip(v["value"]) != "").alias("value")))
    return F.array_sort(F.transform(F.filter(told, lambda e: F.size(e["value"]) > 0), lambda e: F.concat(e["key"], F.lit("="), shape(e["value"]))))


def public_condition(reaction: Column) -> Column:
    """The condition that a question shows: conditions and components with amounts and steps, symbols hidden, as canonical text."""
    shape = lambda vs: F.array_join(F.transform(vs, lambda v: F.concat_ws("@", v["value"], v["step"].cast("string"))), ",")
    roles = ("catalysts", "ligands", "other_components", "additives", "reagents")
    return F.to_json(F.struct(_said(reaction["conditions"], shape).alias("conditions"), *[_parts(reaction[r], ("name", None), ("amount", None), ("step", None)).alias(r) for r in roles]))


def condition_key(reaction: Column) -> Column:
    """The key under which conditions count as equal for grouping: texts folded, ligand amounts left out, lists sorted."""
    shape = lambda vs: F.array_join(F.array_sort(F.transform(vs, lambda v: F.concat_ws("@", t.grouping_text(v["value"]), v["step"].cast("string")))), ",")
    whole = (("name", "name"), ("amount", "amount"), ("step", None))
    roles = {"catalysts": whole, "ligands": (whole[0], whole[2]), "other_components": whole, "additives": whole, "reagents": whole}
    return F.to_json(F.struct(_said(reaction["conditions"], shape).alias("conditions"), *[_parts(reaction[r], *fields).alias(r) for r, fields in roles.items()]))


def has_visible_condition(reaction: Column) -> Column:
    parts = [F.size(F.coalesce(reaction[r], F.array())) > 0 for r in ("catalysts", "ligands", "reagents", "additives", "other_components")]
    out = F.coalesce(F.size(reaction["conditions"]), F.lit(0)) > 0
    for p in parts:
        out = out | p
    return out


def substrate_key(substrates: Column) -> Column:
    """The valid names, sorted with case aside."""
    names = F.filter(F.transform(substrates, lambda c: t.strip(c["name"])), lambda n: ~t.one_of(n, vocab.CONDITION_EMPTY))
    return F.array_sort(names, lambda a, b: F.when(F.lower(a) < F.lower(b), -1).when(F.lower(a) > F.lower(b), 1).otherwise(0))


def scaffold_key(substrates: Column) -> Column:
    return F.array_sort(F.filter(F.transform(substrates, lambda c: c["scaffold"]), lambda s: s.isNotNull() & ~s.isin("", "unknown")))


def valid_product(name: Column, scaffold: Column) -> Column:
    """Whether a product's name tells what it is: not its scaffold, a label, a numbered product or what it looks like."""
    text = t.strip(name)
    lower = F.lower(text)
    vague = t.one_of(name, vocab.CONDITION_EMPTY) | (F.coalesce(F.lower(t.strip(scaffold)), F.lit("")) == lower)
    vague = vague | lower.isin(*vocab.VAGUE_PRODUCTS) | lower.rlike(vocab.NUMBERED_PRODUCT) | lower.rlike(vocab.SHORT_LABEL) | lower.rlike(vocab.LOOKS_OF_PRODUCT)
    return F.coalesce(~vague, F.lit(False))


def product_key(products: Column, names: str = "any") -> Column:
    """<name, scaffold> of the products, sorted with case aside, as canonical text; null without any. Those without a name
    are left out, and with names="described" those whose name doesn't tell what they are."""
    if names not in ("any", "described"):
        raise ValueError(f"unknown rule {names!r} for product names; known are any and described")
    fits = (lambda c: valid_product(c["name"], c["scaffold"])) if names == "described" else (lambda c: ~t.one_of(c["name"], vocab.CONDITION_EMPTY))
    named = F.filter(F.coalesce(products, F.array()), fits)
    pairs = F.array_sort(F.transform(named, lambda c: F.struct(F.lower(t.strip(c["name"])).alias("by"), t.strip(c["name"]).alias("name"), c["scaffold"].alias("scaffold"))))
    return F.when(F.size(pairs) > 0, F.to_json(F.transform(pairs, lambda p: F.struct(p["name"].alias("name"), p["scaffold"].alias("scaffold")))))


def _outcomes(objective: str | None) -> tuple[Column, Column, Column]:
    """(eligible, scored, value) of rows with yield, ee, er and dr. Without an objective every row is eligible, and scores
    by what it has; a row without a value is still scored if it reports a ratio."""
    y, e, er, dr = (F.col(k) for k in ("yield", "ee", "er", "dr"))
    value = m.legacy_score(y, e) if objective is None else m.score(y, e, er, objective)
    eligible = F.lit(True) if objective is None else m.eligibility(y, e, er, objective) == "eligible"
    reported = lambda c: F.coalesce(c, F.lit("")) != ""
    return eligible, value.isNotNull() | reported(er) | reported(dr), value


def _kind(reaction: Column, policy: str) -> Column:
    if policy not in ("required", "ignored"):
        raise ValueError(f"unknown policy {policy!r} for reaction types; known are required and ignored")
    return reaction_type(reaction["reaction_type"]) if policy == "required" else F.lit("")


#: Outcomes that make two options the same: parsed values and ratios as given.
_RESULT = ("ee_value", "yield_value", "er", "dr")


def _results() -> dict[str, Column]:
    return {"ee_value": m.parse_percentage(F.col("ee")), "yield_value": m.parse_percentage(F.col("yield"))}


def condition_questions(reactions: DataFrame, objective: str | None = m.COMBINED, type_policy: str = "required", product_names: str = "any") -> tuple[DataFrame, DataFrame]:
    """(questions, review): which conditions serve one paper's reaction of given substrates and product best.

    reactions: source_paper, reaction_pos, reaction. Rows without a paper or a substrate are left out. Reasons, the first
    that holds: unknown_reaction_type, missing_product, then those of build(). Without an objective all reactions are
    eligible and score by the mean of what they report.
    """
    r = F.col("reaction")
    rows = reactions.filter(t.clean_text(F.col("source_paper")) != "").select("source_paper", "reaction_pos", _kind(r, type_policy).alias("reaction_type"), substrate_key(r["substrates"]).alias("substrates"), product_key(r["products"], product_names).alias("products"), public_condition(r).alias("condition"), *[r["targets"][k].alias(k) for k in ("yield", "ee", "er", "dr")])
    rows = rows.filter(F.size("substrates") > 0)
    early = F.when(F.lower("reaction_type") == vocab.UNKNOWN_REACTION, "unknown_reaction_type").when(F.col("products").isNull(), "missing_product")
    rows = materialize(rows.withColumns({"early": early, **_results()}))  # every aggregate reads them
    group = ["source_paper", "reaction_type", "substrates", "products"]
    eligible, scored, value = _outcomes(objective)
    questions, review = build(rows.filter("early is null"), group, ["condition"], _RESULT, value.isNotNull(), F.coalesce(value, F.lit(0.0)), "reaction_pos", eligible, scored)
    lost = rows.filter("early is not null").groupBy(*group, F.col("early").alias("reason")).agg(F.count("*").alias("n"))
    return questions, review.unionByName(lost)


def substrate_questions(reactions: DataFrame, objective: str | None = m.COMBINED, type_policy: str = "required") -> tuple[DataFrame, DataFrame]:
    """(questions, review): which substrate of one scaffold does best under one condition, the other substrates fixed.

    Each different scaffold of a reaction is the variable one in turn. Reasons, the first that holds: unknown_reaction_type
    (a row for the reactions, without a variable), variable_scaffold_not_unique if some reaction of the group has not just
    one substrate of it, then those of build(), among them fixed_substrate_mismatch. Rows without a paper or a known
    scaffold are left out.
    """
    r = F.col("reaction")
    rows = reactions.filter(t.clean_text(F.col("source_paper")) != "").select("source_paper", "reaction_pos", _kind(r, type_policy).alias("reaction_type"), scaffold_key(r["substrates"]).alias("scaffolds"), condition_key(r).alias("condition"), r["substrates"].alias("substrates"), *[r["targets"][k].alias(k) for k in ("yield", "ee", "er", "dr")])
    rows = materialize(rows.filter(F.size("scaffolds") > 0))
    group = ["source_paper", "reaction_type", "scaffolds", "condition", "variable"]
    unknown = F.lower("reaction_type") == vocab.UNKNOWN_REACTION
    untyped = rows.filter(unknown).withColumn("variable", F.lit(None).cast("string")).groupBy(*group).agg(F.lit("unknown_reaction_type").alias("reason"), F.count("*").alias("n"))
    rows = rows.filter(~unknown).withColumn("variable", F.explode(F.array_distinct("scaffolds")))
    own = lambda c: F.coalesce(F.lower(c["scaffold"]), F.lit("")) == F.lower(F.col("variable"))
    mine = F.filter("substrates", own)
    view = lambda c: F.to_json(F.struct(c["name"].alias("name"), c["scaffold"].alias("scaffold"), c["substituents"].alias("substituents"), c["step"].alias("step")))
    same = lambda c: F.to_json(F.struct(F.coalesce(F.lower(t.strip(c["name"])), F.lit("")).alias("name"), F.coalesce(F.lower(c["scaffold"]), F.lit("")).alias("scaffold"), F.transform(F.coalesce(c["substituents"], F.array()), lambda s: F.lower(s)).alias("substituents")))
    fixed = F.array_join(F.array_sort(F.transform(F.filter("substrates", lambda c: ~own(c)), same)), "&")
    rows = rows.withColumns({"n_mine": F.size(mine), "option": F.array_join(F.transform(mine, view), "&"), "fixed": fixed, **_results()}).drop("substrates")
    rows = materialize(rows)  # every aggregate reads them
    state = rows.groupBy(*group).agg(F.count("*").alias("n"), F.max(F.col("n_mine") != 1).alias("bad"))
    ready = rows.join(state.filter("not bad").select(*group), group, "left_semi")
    eligible, scored, value = _outcomes(objective)
    questions, review = build(ready, group, ["option"], _RESULT, value.isNotNull(), F.coalesce(value, F.lit(0.0)), "reaction_pos", eligible, scored, F.col("fixed"), "insufficient_distinct_variable_substrates", "duplicate_variable_substrate_conflicting_results")
    unsure = state.filter("bad").select(*group, F.lit("variable_scaffold_not_unique").alias("reason"), "n")
    return questions, review.unionByName(unsure).unionByName(untyped)


def overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """left_only, right_only and both: how many distinct keys."""
    sides = left.select(F.col(key).alias("k")).distinct().withColumn("l", F.lit(1)).join(right.select(F.col(key).alias("k")).distinct().withColumn("r", F.lit(1)), "k", "full_outer")
    return sides.agg(F.count_if(F.col("r").isNull()).alias("left_only"), F.count_if(F.col("l").isNull()).alias("right_only"), F.count_if(F.col("l") == F.col("r")).alias("both"))
