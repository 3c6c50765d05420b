"""Reactions as edges, and edges folded back into one row for each reaction."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retort.functions import text as t
from retort.functions import vocab
from retort.operators.resolve import candidates, first_key_pairs

def display_name(c: Column) -> Column:
    """A compound's name in a text: systematic, reliable, resolved, then symbol, label and structure."""
    return t.first_text(c["iupac_name"], t.reliable_name(c["name"], c["symbol"], c["label"]), c["resolved_iupac_name"], c["resolved_name_normalized"], c["resolved_name"], c["symbol"], c["label"], c["smiles"], c["resolved_smiles"], t.strip_amounts(c["text"]))


def image_display_name(c: Column) -> Column:
    """A compound's name in an image: structures first."""
    name = t.reliable_name(c["name"], c["symbol"], c["label"])
    smiles = t.looks_like_smiles(name)
    return t.first_text(c["smiles"], F.when(smiles, name), c["resolved_smiles"], c["iupac_name"], c["resolved_iupac_name"], c["resolved_name_normalized"], c["resolved_name"], F.when(~smiles, name), t.strip_amounts(c["text"]), c["label"], c["symbol"])


def structure_identifier(c: Column, modality: str) -> Column:
    """struct<value, source> of what a provider can draw a compound by, and the field that it stands in; "" if nothing."""
    name = t.clean_text(c["name"])
    plain = lambda *fields: [(f, t.clean_text(c[f])) for f in fields]
    if modality == "image":
        drawn = t.looks_like_smiles(name)
        ways = [*plain("smiles"), ("name", F.when(drawn, name)), *plain("resolved_smiles", "iupac_name", "resolved_iupac_name", "resolved_name_normalized", "resolved_name"), ("name", F.when(~drawn, name)), *plain("label", "symbol")]
    else:
        ways = [*plain("iupac_name", "resolved_iupac_name", "resolved_name_normalized", "resolved_name"), ("name", name)]
    found = F.filter(F.array(*[F.struct(v.alias("value"), F.lit(f).alias("source")) for f, v in ways]), lambda x: x["value"] != "")
    return F.coalesce(F.try_element_at(found, F.lit(1)), F.struct(F.lit("").alias("value"), F.lit("").alias("source")))


def substrate_display_name(c: Column, policy: str) -> Column:
    """A substrate's name by policy: `resolved`, `original_if_available` or `registry_if_resolved_else_original`."""
    own, given = display_name(c), F.nullif(t.clean_text(c["original_name"]), F.lit(""))
    if policy == "resolved":
        return own
    if policy == "original_if_available":
        series = F.when(t.clean_text(c["resolution_evidence"]["match_type"]) == "underspecified_series_label", F.nullif(t.clean_text(c["symbol"]), F.lit("")))
        return F.coalesce(series, given, own)
    if policy == "registry_if_resolved_else_original":
        by_registry = (t.clean_text(c["resolution_source"]) == "name_registry") & (F.lower(t.clean_text(c["registry_match_status"])) != "conflict")
        return F.when(by_registry, t.first_text(c["name"], own)).otherwise(F.coalesce(given, own))
    raise ValueError(f"unknown policy {policy!r}")


def solvent_entries(conditions: Column) -> Column:
    """array<struct<name, amount, step>> of solvents, paired with amounts by position in their step; "" where one lacks.
    A name of "" marks an amount without a solvent. `volume` stands in where no solvent_amount is given."""
    values = lambda k: F.filter(F.transform(F.coalesce(F.try_element_at(conditions, F.lit(k)), F.array()), lambda v: F.struct(v["step"].alias("step"), t.clean_text(v["value"]).alias("value"))), lambda v: v["value"] != "")
    at = lambda xs, s: F.transform(F.filter(xs, lambda v: v["step"].eqNullSafe(s)), lambda v: v["value"])

    def paired(x: Column) -> Column:
        steps = F.array_distinct(F.transform(F.concat(x["solvents"], x["amounts"]), lambda v: v["step"]))
        return F.flatten(F.transform(steps, lambda s: F.transform(F.arrays_zip(at(x["solvents"], s).alias("a"), at(x["amounts"], s).alias("b")), lambda z: F.struct(F.coalesce(z["a"], F.lit("")).alias("name"), F.coalesce(z["b"], F.lit("")).alias("amount"), s.alias("step")))))

    amounts = t.bound(values("solvent_amount"), lambda own: F.when(F.size(own) > 0, own).otherwise(values("volume")))
    return t.bound(F.struct(values("solvent").alias("solvents"), amounts.alias("amounts")), paired)


def condition_summaries(conditions: Column) -> Column:
    """array<struct<text, step>>: per step, in order, "label: value" parts joined by "; ", amounts without a solvent first;
    parts without a step come last."""
    spare = F.transform(F.filter(solvent_entries(conditions), lambda e: e["name"] == ""), lambda e: F.struct(e["step"].alias("step"), F.concat(F.lit("solvent_amount: "), e["amount"]).alias("part")))

    def labelled(key: str, label: str) -> Column:
        part = lambda v: F.concat(F.lit(f"{label}: "), F.nullif(t.clean_text(v["value"]), F.lit("")))
        return F.transform(F.coalesce(F.try_element_at(conditions, F.lit(key)), F.array()), lambda v: F.struct(v["step"].alias("step"), part(v).alias("part")))

    parts = F.filter(F.concat(spare, *[labelled(k, v) for k, v in vocab.CONDITION_LABELS.items()]), lambda p: p["part"].isNotNull())
    at = lambda p: F.coalesce(p["step"], F.lit(1 << 30))
    text = lambda ps, s: F.array_join(F.transform(F.filter(ps, lambda p: at(p) == s), lambda p: p["part"]), "; ")
    said = lambda ps: F.transform(F.sort_array(F.array_distinct(F.transform(ps, at))), lambda s: F.struct(text(ps, s).alias("text"), F.when(s < (1 << 30), s.cast("string")).otherwise("").alias("step")))
    return t.bound(parts, said)


def _edges(items: Column, relation: str, y_type: str, name: Callable, step: Callable, amount: Callable | None = None) -> Column:
    return F.transform(
        F.coalesce(items, F.array()),
        lambda c: F.struct(F.lit(relation).alias("relationship"), name(c).alias("y_name"), F.lit(y_type).alias("y_type"), F.coalesce(step(c).cast("string"), F.lit("")).alias("step"), (amount(c) if amount else F.lit("")).alias("amount")),
    )


def image_edges(reactions: DataFrame) -> DataFrame:
    """As text_edges(), for reactions of images (with `source_image`): structures name compounds, nothing is said of pages or
    intermediates, and each reaction points to its image."""
    return text_edges(reactions, "resolved", image=True)


def text_edges(reactions: DataFrame, policy: str = "resolved", image: bool = False) -> DataFrame:
    """The edges of reactions (source_paper, reaction struct): one pass, an array of edges for each reaction, without
    repeats, inlined.

    Compounds without a name are an `unknown` node, intermediates without one vanish. Additives and reagents are other
    components. Outcomes are on every edge. Rows are distinct in all columns.
    """
    r = F.col("reaction")
    no_step = lambda c: F.lit("")
    named = lambda c: t.first_text(image_display_name(c) if image else display_name(c), F.lit("unknown"))
    picture = F.col("source_image") if image else F.lit("")
    # One array of all roles, so that the names' expression stands in the plan once and not for each role.
    tagged = lambda rel, own: lambda c: F.struct(F.lit(rel).alias("relationship"), F.lit(own).alias("own"), c.alias("c"))
    sides = {"substrates": "USES_SUBSTRATE", "products": "PRODUCES", "catalysts": "USES_CATALYST", "ligands": "USES_LIGAND", "other_components": "USES_OTHER_COMPONENT", "additives": "USES_OTHER_COMPONENT", "reagents": "USES_OTHER_COMPONENT"}
    every = F.concat(*[F.transform(F.coalesce(r[f], F.array()), tagged(rel, f == "substrates")) for f, rel in sides.items()])
    own_name = (lambda x: named(x["c"])) if image or policy == "resolved" else (lambda x: F.when(x["own"], t.first_text(substrate_display_name(x["c"], policy), F.lit("unknown"))).otherwise(named(x["c"])))
    of_roles = F.transform(every, lambda x: F.struct(x["relationship"].alias("relationship"), own_name(x).alias("y_name"), F.lit("Compound").alias("y_type"), F.coalesce(x["c"]["step"].cast("string"), F.lit("")).alias("step"), t.clean_text(x["c"]["amount"]).alias("amount")))
    inter = F.filter(F.coalesce(r["intermediates"], F.array()), lambda i: t.first_text(i["name"], i["symbol"]) != "")
    inter_name = lambda i: t.first_text(i["name"], i["symbol"])
    produced = F.transform(F.filter(inter, lambda i: i["produced_in_step"].isNotNull()), inter_name)
    solvents = F.filter(solvent_entries(r["conditions"]), lambda e: e["name"] != "")
    of_type = t.first_text(r["reaction_type"], F.lit(vocab.UNKNOWN_REACTION))
    one = lambda relation, name, y_type: F.array(F.struct(F.lit(relation).alias("relationship"), name.alias("y_name"), F.lit(y_type).alias("y_type"), F.lit("").alias("step"), F.lit("").alias("amount")))
    compounds = F.concat(*[F.coalesce(r[f], F.array()) for f in ("substrates", "products")])
    everything = F.concat(
        one("REPORTED_IN", F.col("source_paper"), "Paper"),
        one("OF_TYPE", of_type, "ReactionType"),
        _edges(solvents, "USES_SOLVENT", "Compound", lambda e: e["name"], lambda e: e["step"], lambda e: e["amount"]),
        F.transform(condition_summaries(r["conditions"]), lambda c: F.struct(F.lit("HAS_CONDITION").alias("relationship"), c["text"].alias("y_name"), F.lit("Condition").alias("y_type"), c["step"].alias("step"), F.lit("").alias("amount"))),
        of_roles,
        _edges(F.filter(compounds, lambda c: t.clean_text(c["scaffold"]) != ""), "HAS_SCAFFOLD", "Scaffold", lambda c: t.clean_text(c["scaffold"]), no_step),
        F.flatten(F.transform(compounds, lambda c: _edges(F.transform(F.coalesce(c["substituents"], F.array()), lambda s: F.struct(s.alias("s"))), "HAS_SUBSTITUENT", "Substituent", lambda s: t.clean_text(s["s"]), no_step))),
        _edges(F.filter(inter, lambda i: i["produced_in_step"].isNotNull()), "PRODUCES_INTERMEDIATE", "Compound", inter_name, lambda i: i["produced_in_step"]),
        _edges(F.filter(inter, lambda i: i["consumed_in_step"].isNotNull()), "USES_INTERMEDIATE", "Compound", inter_name, lambda i: i["consumed_in_step"]),
    )
    if image:
        everything = F.concat(F.filter(everything, lambda e: ~e["relationship"].isin("PRODUCES_INTERMEDIATE", "USES_INTERMEDIATE")), one("EXTRACTED_FROM_IMAGE", picture, "Image"))
    node = F.concat_ws(":", F.lit("ImageReaction" if image else "TextReaction"), F.col("source_paper"), *([picture] if image else []), r["id"])
    target = lambda k: t.clean_text(r["targets"][k]).alias(k)
    pages = F.lit("") if image else F.array_join(F.transform(F.coalesce(r["source_pages"], F.array()), lambda p: p.cast("string")), ", ")
    one_row = reactions.select(node.alias("x_name"), F.col("source_paper").alias("pdf_name"), pages.alias("source_pages"), picture.alias("source_image"), *[target(k) for k in ("yield", "ee", "er", "dr")], everything.alias("_edges"))
    # Repeats are of one node: reactions are shuffled by it, not their many wide edges, and what folds edges by reaction needn't shuffle again.
    placed = one_row.filter("x_name <> ''").repartition("x_name")
    merged = placed.groupBy(*[c for c in placed.columns if c != "_edges"]).agg(F.array_distinct(F.flatten(F.collect_list("_edges"))).alias("_edges"))
    rows = merged.select(*[c for c in merged.columns if c != "_edges"], F.lit("Reaction").alias("x_type"), F.inline("_edges")).filter("y_name <> ''")
    rows = rows.withColumn("reaction_id", F.col("x_name")).withColumn("source_modality", F.lit("image" if image else "text"))
    return route_amounts(rows).select(*vocab.EDGE_COLUMNS)


def route_amounts(edges: DataFrame) -> DataFrame:
    """The column `amount` goes to its relationship's own column; the others are ""."""
    return edges.withColumns({c: F.when(F.col("relationship") == r, F.col("amount")).otherwise("") for r, c in vocab.AMOUNT_COLUMNS.items()}).drop("amount")


#: Columns of an edge that differ among the edges of a node.
_OF_EDGE = ("relationship", "y_name", "y_type", "step", *vocab.AMOUNT_COLUMNS.values())


def dedupe_edges(edges: DataFrame) -> DataFrame:
    """Distinct edges. Those of a reaction are few and are shuffled as one set, with the wide columns that they share once;
    other nodes may have any number of edges, each of which is a set of its own."""
    used = edges.filter("x_name <> '' and y_name <> ''")
    if "x_type" not in used.columns:
        return used.distinct()
    own = [c for c in used.columns if c in _OF_EDGE]
    shared = [c for c in used.columns if c not in own]
    alone = F.when(F.coalesce(F.col("x_type") != "Reaction", F.lit(True)), F.xxhash64(*own)).alias("_alone")
    found = used.groupBy(*shared, alone).agg(F.collect_set(F.struct(*own)).alias("_edges"))
    return found.select(*shared, F.inline("_edges")).select(*used.columns)


def alignment_edges(alignments: DataFrame) -> DataFrame:
    """Edges of alignments (method, text_id, text_name, image_id, image_name, pdf_name): a NAME_RESOLVED_BY points from image to text."""
    back = F.col("relationship") == "NAME_RESOLVED_BY"
    pick = lambda a, b: F.when(back, F.col(a)).otherwise(F.col(b))
    named = alignments.filter(F.col("relationship").isin("SAME_AS", "NAME_RESOLVED_BY")).select(pick("image_name", "text_name").alias("x_name"), F.lit("Compound").alias("x_type"), "relationship", pick("text_name", "image_name").alias("y_name"), F.lit("Compound").alias("y_type"), "pdf_name", F.lit("text+image").alias("source_modality"))
    return dedupe_edges(named.withColumns({c: F.lit("") for c in vocab.EDGE_COLUMNS if c not in named.columns}).select(*vocab.EDGE_COLUMNS))


def unify(*graphs: DataFrame) -> DataFrame:
    found = graphs[0].select(*vocab.EDGE_COLUMNS)
    for g in graphs[1:]:
        found = found.unionByName(g.select(*vocab.EDGE_COLUMNS))
    return dedupe_edges(found)


def relation_counts(edges: DataFrame, *by: str) -> DataFrame:
    return edges.groupBy(*by, "relationship").agg(F.count("*").alias("n"))


def split_condition(text: Column) -> Column:
    """The parts of a condition text: at each ";" and at each comma before a known label."""
    parts = F.split(t.clean_text(text), r"(?i);\s*|,\s*(?=(?:solvent|solvent_amount|solvent amount|vol|volume|temp|time|atm|light|wl|conc)\s*:)")
    return F.filter(F.transform(parts, t.strip), lambda p: p != "")


def condition_label(part: Column) -> Column:
    """The label of "label: value", lower-cased, with spaces for underscores; "" if there is none."""
    return F.replace(F.lower(t.clean_text(F.regexp_extract(part, r"\A\s*([^:：]+)\s*[:：]", 1))), F.lit("_"), F.lit(" "))


def condition_value(part: Column) -> Column:
    return t.clean_text(F.regexp_extract(part, r"\A\s*[^:：]+\s*[:：]\s*(.*)", 1))


def legacy_solvents(parts: Column, order: Column) -> Column:
    """Items of USES_SOLVENT from ordered parts <o, s, named, v>: in each step the n-th name with the n-th amount, and amounts
    without a name as "solvent_amount: x"."""
    steps = F.array_distinct(F.transform(parts, lambda p: p["s"]))
    of = lambda s, named: F.array_distinct(F.transform(F.filter(parts, lambda p: (p["s"] == s) & (p["named"] == named)), lambda p: p["v"]))
    text = lambda z: F.when(z["a"].isNull(), F.concat(F.lit("solvent_amount: "), z["b"])).when(z["b"].isNull(), z["a"]).otherwise(F.concat(z["a"], F.lit(" ("), z["b"], F.lit(")")))
    pairs = lambda s: F.transform(F.arrays_zip(of(s, True).alias("a"), of(s, False).alias("b")), lambda z: F.struct(order.alias("o"), F.lit("USES_SOLVENT").alias("r"), s.alias("s"), text(z).alias("v")))
    return F.flatten(F.transform(steps, pairs))


def legacy_edges(reactions: DataFrame) -> DataFrame:
    """The older graph of reactions (source_paper, reaction_pos, reaction): x_name, relationship, y_name, step and amount of
    distinct triples; the first reaction of a (paper, id) counts, and one without an id is reaction_<pos>."""
    r = F.col("reaction")
    one = reactions.withColumn("_id", F.coalesce(r["id"], F.concat(F.lit("reaction_"), F.col("reaction_pos").cast("string"))))
    name = lambda c: t.first_text(c["name"], c["symbol"])
    sides = {"substrates": "USES_SUBSTRATE", "products": "PRODUCES", "catalysts": "USES_CATALYST", "ligands": "USES_LIGAND", "other_components": "USES_OTHER_COMPONENT", "additives": "USES_ADDITIVE", "reagents": "USES_REAGENT"}
    triple = lambda rel: lambda c: F.struct(F.lit(rel).alias("relationship"), name(c).alias("y_name"), c["step"].alias("step"), t.clean_text(c["amount"]).alias("amount"))
    made = F.concat(*[F.transform(F.coalesce(r[f], F.array()), triple(rel)) for f, rel in sides.items()])
    # Triples are what is shuffled: of a reaction's compounds they hold four fields.
    first = one.select("source_paper", "_id", "reaction_pos", F.array_distinct(made).alias("_made")).groupBy("source_paper", "_id").agg(F.min_by("_made", "reaction_pos").alias("_made"))
    rows = first.select(F.concat_ws(":", "source_paper", "_id").alias("x_name"), F.inline("_made")).filter("y_name <> ''")
    return rows.groupBy("x_name", "relationship", "y_name", "step").agg(F.min("amount").alias("amount"))


def fold_edges(edges: DataFrame, order: str = "pos") -> DataFrame:
    """One row for each reaction of edges with an order column: per role the distinct "name (amount)" values, those
    without a step first, then "stepN: a; b"; outcomes are the first that aren't empty.

    One aggregate by reaction: values are gathered once as structs, and arrays do the rest.
    """
    r, step = F.col("relationship"), F.coalesce(F.regexp_extract("step", r"(?i)\A(?:step\s*)?(\d+)\z", 1).try_cast("int"), F.lit(0))
    amount = F.coalesce(*[F.when(r == k, F.nullif(F.col(c), F.lit(""))) for k, c in vocab.AMOUNT_COLUMNS.items()], F.lit(""))
    value = F.when(amount != "", F.concat("y_name", F.lit(" ("), amount, F.lit(")"))).otherwise(F.col("y_name"))
    used = edges.filter((F.col("source_modality") != "text+image") & (F.col("reaction_id") != "") & (~r.isin(*vocab.IGNORED_RELATIONS)))
    item = F.struct(F.col(order).alias("o"), r.alias("r"), step.alias("s"), value.alias("v"))
    # Solvents that an older form keeps among the conditions are told apart first; the rest of the text stays a condition.
    parts = split_condition(F.col("y_name"))
    is_legacy = (r == "HAS_CONDITION") & F.exists(parts, lambda p: condition_label(p).isin(*vocab.SOLVENT_LABELS))
    legacy = F.transform(F.filter(F.transform(parts, lambda p: F.struct(condition_label(p).alias("label"), condition_value(p).alias("value"))), lambda p: p["label"].isin(*vocab.SOLVENT_LABELS) & (p["value"] != "")), lambda p: F.struct(F.col(order).alias("o"), step.alias("s"), p["label"].isin(*vocab.SOLVENT_NAME_LABELS).alias("named"), p["value"].alias("v")))
    kept = F.array_join(F.filter(parts, lambda p: ~condition_label(p).isin(*vocab.SOLVENT_LABELS)), "; ")
    used = used.withColumn("_legacy", F.when(is_legacy, legacy)).withColumn("y_name", F.when(is_legacy, kept).otherwise(F.col("y_name")))
    item = F.when(F.col("y_name") != "", item)
    first = lambda c: F.coalesce(F.min(F.when(F.col(c) != "", F.struct(F.col(order), F.col(c).alias("v"))))["v"], F.lit("")).alias(c)
    pages = F.array_sort(F.array_distinct(F.flatten(F.collect_set(t.page_numbers(F.col("source_pages")))))).alias("pages")
    rows = used.groupBy("reaction_id").agg(F.min(F.struct(order, "pdf_name"))["pdf_name"].alias("paper"), F.min(order).alias("first_pos"), F.sort_array(F.collect_list(item)).alias("items"), F.sort_array(F.flatten(F.collect_list("_legacy"))).alias("legacy"), pages, *[first(c) for c in ("yield", "ee", "er", "dr")])
    rows = rows.withColumn("items", F.concat("items", legacy_solvents(F.col("legacy"), F.try_element_at("items", F.lit(1))["o"])))
    role = lambda *rels: render_steps(F.filter("items", lambda x: x["r"].isin(*rels)))
    produced = F.transform(F.filter("items", lambda x: x["r"] == "PRODUCES_INTERMEDIATE"), lambda x: x["v"])
    between = F.filter("items", lambda x: (x["r"] == "PRODUCES_INTERMEDIATE") | ((x["r"] == "USES_INTERMEDIATE") & ~F.array_contains(produced, x["v"])))
    local = F.element_at(F.split("reaction_id", ":"), -1)
    location = F.when(F.size("pages") > 0, F.concat(local, F.lit("; PDF pages: "), F.array_join(F.transform("pages", lambda p: p.cast("string")), ", "))).otherwise(local)
    return rows.select(
        "reaction_id", "paper", "first_pos", location.alias("location"), role("USES_SUBSTRATE").alias("substrate"), role("PRODUCES").alias("product"), render_steps(between).alias("intermediate"),
        role("USES_CATALYST").alias("catalyst"), role("USES_LIGAND").alias("ligand"), role("USES_SOLVENT").alias("solvent"), role("USES_OTHER_COMPONENT", "USES_ADDITIVE", "USES_REAGENT").alias("other_component"),
        role("HAS_CONDITION").alias("conditions"), "yield", "dr", "ee", "er", F.lit("").alias("review_1"), F.lit("").alias("review_2"),
    )


def render_steps(items: Column) -> Column:
    """Distinct values in order: those of step 0 as they are, then "stepN: a; b" by N, all joined by "; "."""
    steps = F.array_sort(F.array_distinct(F.transform(items, lambda x: x["s"])))
    at = lambda s: F.array_distinct(F.transform(F.filter(items, lambda x: x["s"] == s), lambda x: x["v"]))
    return F.array_join(F.transform(steps, lambda s: F.when(s == 0, F.array_join(at(s), "; ")).otherwise(F.concat(F.lit("step"), s.cast("string"), F.lit(": "), F.array_join(at(s), "; ")))), "; ")


def mentions(compounds: DataFrame, modality: str) -> DataFrame:
    """Entities of exploded compounds, with an id "modality:paper:reaction:field:position" and the keys they meet by."""
    c = F.col("compound")
    name = display_name(c) if modality == "text" else image_display_name(c)
    return compounds.select(
        F.concat_ws(":", F.lit(modality), "source_paper", "id", "field", F.col("item_pos").cast("string")).alias("entity_id"), "source_paper", "field", name.alias("name"),
        t.normalize_iupac(t.first_text(c["iupac_name"], c["resolved_iupac_name"])).alias("iupac"), t.first_text(c["smiles"], c["resolved_smiles"]).alias("smiles"), t.normalize_symbol(F.coalesce(c["symbol"], c["label"])).alias("symbol"), t.main_token(c["name"]).alias("token"),
    )


def align(text: DataFrame, image: DataFrame) -> DataFrame:
    """Alignments of text and image entities: SAME_AS by systematic name, NAME_RESOLVED_BY by a text symbol that is unique
    in the paper, CANDIDATE_SAME_AS by any key for the images left, which never enter the graph."""
    scope: Sequence[str] = ["source_paper"]
    pair = ["text_id", "image_id", "relationship", "method", "confidence"]
    a, b = text.withColumnRenamed("entity_id", "text_id"), image.withColumnRenamed("entity_id", "image_id")
    same = first_key_pairs(a, b, scope, ("iupac",), "text_id", "image_id").select("text_id", "image_id", F.lit("SAME_AS").alias("relationship"), "method", F.lit("high").alias("confidence"))
    named = b.filter("iupac <> ''").join(a.filter("iupac <> ''").select(*scope, "iupac"), [*scope, "iupac"], "left_semi")
    unique = a.filter("symbol <> '' and name <> ''").groupBy(*scope, "symbol").agg(F.count_distinct(F.lower("name")).alias("n"), F.min("text_id").alias("text_id")).filter("n = 1")
    rest = b.filter("iupac = '' and smiles = ''")
    resolved = rest.join(unique, [*scope, "symbol"]).select("text_id", "image_id", F.lit("NAME_RESOLVED_BY").alias("relationship"), F.lit("symbol").alias("method"), F.lit("medium").alias("confidence"))
    strong = same.unionByName(resolved)
    aligned = named.select("image_id").unionByName(resolved.select("image_id"))  # an image's own rows tell, and no pairs are made for it
    weak = candidates(b.filter("iupac = ''"), aligned, a, scope, ("symbol", "token", "name"), "image_id", "text_id")
    weak = weak.select("text_id", "image_id", F.lit("CANDIDATE_SAME_AS").alias("relationship"), "method", F.lit("low").alias("confidence"))
    return strong.unionByName(weak).select(*pair)
