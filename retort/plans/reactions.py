"""Reactions built from orders, their lines and parts, through the operators of the graph, the filters and the questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from retort import schemas
from retort.functions import metrics as m
from retort.functions import text as t
from retort.operators import canon, dedupe, filters, graph, procedures, questions, reports, validation
from retort.plans.base import dealt, query
from retort.storage import materialize

#: Line numbers of an order by the role that their parts play; solvent, its amount and temperature are conditions.
ROLE_OF_LINE = {1: "substrates", 2: "products", 3: "catalysts", 4: "ligands", 6: "other_components"}
SOLVENT_LINE, TEMPERATURE_LINE = 5, 7


def reactions(table, modality: str = "text"):
    """source_paper, reaction_pos and reaction of every order with lines: its parts are compounds, by line number."""
    line = table("lineitem").join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
    line = line.select("l_orderkey", F.col("l_linenumber").cast("int").alias("n"), "l_partkey", "p_name", "p_brand", "p_type", F.col("l_quantity").cast("int").alias("q"), "l_discount")
    item = F.struct("n", "l_partkey", "p_name", "p_brand", "p_type", "q")  # compounds are made of it behind the shuffle: most of their fields are null
    made_of = lambda x: schemas.compound(name=x["p_name"], symbol=F.concat(F.lit("P"), x["l_partkey"].cast("string")), amount=F.concat(x["q"].cast("string"), F.lit(" mmol")), step=x["n"], scaffold=x["p_brand"], substituents=F.array(x["p_type"]))
    role = lambda n: F.transform(F.filter("items", lambda x: x["n"] == n), made_of)
    at = lambda n, v: F.when(v.isNull(), F.lit(None)).otherwise(F.array(F.struct(F.lit(n).alias("step"), v.alias("value"))))
    made = line.groupBy("l_orderkey").agg(
        F.collect_list(F.when(F.col("n").isin(*ROLE_OF_LINE), item)).alias("items"),
        F.min(F.when(F.col("n") == SOLVENT_LINE, F.col("p_name"))).alias("solvent"),
        F.max(F.when(F.col("n") == SOLVENT_LINE, F.col("q"))).cast("string").alias("volume"),
        F.max(F.when(F.col("n") == TEMPERATURE_LINE, F.col("q"))).cast("string").alias("degrees"),
        F.round(F.max("l_discount") * 100).cast("int").alias("percent"),
    )
    empty = F.array().cast(f"array<{schemas.COMPOUND}>")
    entries = F.array(
        F.struct(F.lit("solvent").alias("key"), at(SOLVENT_LINE, F.col("solvent")).alias("value")),
        F.struct(F.lit("solvent_amount").alias("key"), at(SOLVENT_LINE, F.concat("volume", F.lit(" mL"))).alias("value")),
        F.struct(F.lit("temperature").alias("key"), at(TEMPERATURE_LINE, F.concat("degrees", F.lit(" C"))).alias("value")),
    )
    whole = F.struct(
        F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("id"),
        F.col("o_orderpriority").alias("reaction_type"),
        F.lit(None).cast("array<int>").alias("source_pages"),
        F.lit(None).cast("int").alias("step_count"),
        F.lit(None).cast("string").alias("gp_source"),
        *[role(n).alias(r) for n, r in ROLE_OF_LINE.items()],
        empty.alias("additives"),
        empty.alias("reagents"),
        F.array().cast(f"array<{schemas.INTERMEDIATE}>").alias("intermediates"),
        F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())).alias("conditions"),
        F.struct(
            F.when(F.col("o_orderkey") % 7 != 0, F.concat(F.col("percent").cast("string"), F.lit("%"))).alias("yield"),
            F.lit(None).cast("string").alias("ee"),
            F.when(F.col("o_orderkey") % 5 == 0, F.lit("95:5")).alias("er"),
            F.lit(None).cast("string").alias("dr"),
        ).alias("targets"),
    )
    paper = F.concat(F.lit("paper"), (F.col("o_custkey") % 50).cast("string"))
    out = made.join(table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    out = out.select(paper.alias("source_paper"), F.col("o_orderkey").alias("reaction_pos"), F.lit(modality).alias("source_modality"), F.concat(F.lit("img"), F.col("o_orderkey") % 9).alias("source_image"), whole.alias("reaction"))
    return materialize(out)  # as a payload scan gives them; operators read fields of a column, not of the expression that made it


_ORDERS = """o AS (SELECT o_orderkey, 'paper' || (o_custkey % 50) AS paper, o_orderpriority AS kind, CASE WHEN o_orderkey % 7 <> 0 THEN round(100 * (SELECT max(l_discount) FROM lineitem WHERE l_orderkey = o_orderkey))::INTEGER || '%' ELSE '' END AS y,
  CASE WHEN o_orderkey % 5 = 0 THEN '95:5' ELSE '' END AS er FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
i AS (SELECT l_orderkey AS o_orderkey, l_linenumber AS n, p_name, p_brand, p_type, l_quantity::INTEGER || ' mmol' AS amount, l_quantity::INTEGER AS q FROM lineitem JOIN part ON l_partkey = p_partkey),
v AS (SELECT o_orderkey, min(p_name) FILTER (n = 5) AS solvent, max(q) FILTER (n = 5) AS volume, max(q) FILTER (n = 7) AS degrees FROM i GROUP BY 1)"""
_ROLES = "CASE n WHEN 1 THEN 'USES_SUBSTRATE' WHEN 2 THEN 'PRODUCES' WHEN 3 THEN 'USES_CATALYST' WHEN 4 THEN 'USES_LIGAND' ELSE 'USES_OTHER_COMPONENT' END"


def _edges_sql(node: str, image: str = "") -> str:
    return f"""WITH {_ORDERS}, e AS (
      SELECT o_orderkey, 'REPORTED_IN' AS relationship, paper AS y_name, 'Paper' AS y_type, '' AS step, '' AS amount FROM o
      UNION SELECT o_orderkey, 'OF_TYPE', kind, 'ReactionType', '', '' FROM o
      UNION SELECT o_orderkey, {_ROLES}, p_name, 'Compound', n::VARCHAR, amount FROM i WHERE n IN (1, 2, 3, 4, 6)
      UNION SELECT o_orderkey, 'HAS_SCAFFOLD', p_brand, 'Scaffold', '', '' FROM i WHERE n IN (1, 2)
      UNION SELECT o_orderkey, 'HAS_SUBSTITUENT', p_type, 'Substituent', '', '' FROM i WHERE n IN (1, 2)
      UNION SELECT o_orderkey, 'USES_SOLVENT', solvent, 'Compound', '5', volume || ' mL' FROM v WHERE solvent IS NOT NULL
      UNION SELECT o_orderkey, 'HAS_CONDITION', 'temp: ' || degrees || ' C', 'Condition', '7', '' FROM v WHERE degrees IS NOT NULL {image})
    SELECT {node} AS x_name, relationship, y_name, y_type, step, amount, y AS "yield", er FROM e JOIN o USING (o_orderkey)"""


def _edge_rows(edges):
    amount = F.concat(*[c for c in edges.columns if c.endswith("_amount")])
    return edges.select("x_name", "relationship", "y_name", "y_type", "step", amount.alias("amount"), "yield", "er")


@query("text_reaction_edges", _edges_sql("'TextReaction:' || paper || ':r' || o_orderkey"))
def text_reaction_edges(spark, table):
    return _edge_rows(graph.text_edges(reactions(table)))


@query("image_reaction_edges", _edges_sql("'ImageReaction:' || paper || ':img' || (o_orderkey % 9) || ':r' || o_orderkey", "UNION SELECT o_orderkey, 'EXTRACTED_FROM_IMAGE', 'img' || (o_orderkey % 9), 'Image', '', '' FROM o"))
def image_reaction_edges(spark, table):
    return _edge_rows(graph.image_edges(reactions(table, "image")))


@query(
    "reaction_summaries",
    f"""WITH {_ORDERS}, s AS (SELECT DISTINCT o_orderkey, n, p_name, p_name || ' (' || amount || ')' AS v FROM i),
    side AS (SELECT o_orderkey, n, 'step' || n || ': ' || string_agg(v, '; ' ORDER BY p_name, v) AS t FROM s GROUP BY o_orderkey, n)
    SELECT 'TextReaction:' || paper || ':r' || o_orderkey AS reaction_id, paper, 'r' || o_orderkey AS location, coalesce(a.t, '') AS substrate, coalesce(b.t, '') AS product,
      coalesce('step5: ' || solvent || ' (' || volume || ' mL)', '') AS solvent, coalesce('step7: temp: ' || degrees || ' C', '') AS conditions, y AS "yield", er
    FROM o JOIN v USING (o_orderkey) LEFT JOIN side a ON a.o_orderkey = o.o_orderkey AND a.n = 1 LEFT JOIN side b ON b.o_orderkey = o.o_orderkey AND b.n = 2""".replace("|| o_orderkey AS", "|| o.o_orderkey AS"),
)
def reaction_summaries(spark, table):
    edges = graph.text_edges(reactions(table)).withColumn("pos", F.struct("relationship", "step", "y_name"))
    return graph.fold_edges(edges).select("reaction_id", "paper", "location", "substrate", "product", "solvent", "conditions", "yield", "er")


@query(
    "older_solvent_fields",
    """SELECT c_custkey, 'step2: ' || CASE c_custkey % 3 WHEN 0 THEN c_mktsegment || ' (' || c_nationkey || ' mL)' WHEN 1 THEN c_mktsegment ELSE 'solvent_amount: ' || c_nationkey || ' mL' END AS solvent,
       'step2: temp: 20 C; time: 3 h' AS conditions FROM customer""",
)
def older_solvent_fields(spark, table):
    """Solvents among the conditions of an edge, in the older form, are paired by step and taken out of them."""
    k, amount = F.col("c_custkey") % 3, F.concat(F.lit("volume: "), F.col("c_nationkey").cast("string"), F.lit(" mL"))
    solvent = F.concat(F.lit("solvent: "), F.col("c_mktsegment"))
    said = F.concat_ws("; ", F.when(k < 2, solvent), F.when(k != 1, amount), F.lit("temp: 20 C; time: 3 h"))
    blank = {c: F.lit("") for c in ("source_pages", "yield", "ee", "er", "dr", "substrate_amount", "product_amount", "catalyst_amount", "ligand_amount", "solvent_amount", "other_component_amount", "additive_amount", "reagent_amount")}
    edges = table("customer").select(F.col("c_custkey").cast("string").alias("reaction_id"), F.lit("HAS_CONDITION").alias("relationship"), said.alias("y_name"), F.lit("p").alias("pdf_name"), F.lit("Step 2").alias("step"), F.lit("text").alias("source_modality"), F.lit(1).alias("pos")).withColumns(blank)
    return graph.fold_edges(edges).select(F.col("reaction_id").cast("long").alias("c_custkey"), "solvent", "conditions")


@query(
    "reaction_reasons",
    f"""WITH {_ORDERS}, s AS (SELECT o_orderkey, list_sort(list_distinct(list(p_name) FILTER (n = 1))) AS a, list_sort(list_distinct(list(p_name) FILTER (n = 2))) AS b FROM i GROUP BY 1)
    SELECT o_orderkey AS reaction_pos, CASE WHEN coalesce(len(a), 0) = 0 OR coalesce(len(b), 0) = 0 THEN 'empty_side' WHEN a = b THEN 'same_names' WHEN y = '' AND er = '' THEN 'target' END AS reason FROM o JOIN s USING (o_orderkey)""",
)
def reaction_reasons(spark, table):
    return filters.label_reactions(reactions(table)).select("reaction_pos", "reason")


@query(
    "older_edges",
    f"""WITH {_ORDERS} SELECT paper || ':r' || o_orderkey AS x_name, {_ROLES} AS relationship, p_name AS y_name, n::INTEGER AS step, min(amount) AS amount FROM i JOIN o USING (o_orderkey) WHERE n IN (1, 2, 3, 4, 6) GROUP BY ALL""",
)
def older_edges(spark, table):
    return graph.legacy_edges(reactions(table))


@query(
    "older_reactions",
    f"""WITH {_ORDERS} SELECT o.o_orderkey AS reaction_pos, CASE WHEN o.o_orderkey % 3 = 0 THEN 'reaction_' || o.o_orderkey ELSE 'r' || o.o_orderkey END AS id, count(*) FILTER (n = 1) AS n_substrates, count(*) FILTER (n = 4) AS n_ligands,
      CASE WHEN o.o_orderkey % 2 = 0 THEN 0 ELSE count(DISTINCT n) FILTER (n = 5) * 2 + count(DISTINCT n) FILTER (n = 7) END AS n_conditions FROM o JOIN i ON i.o_orderkey = o.o_orderkey GROUP BY o.o_orderkey""",
)
def older_reactions(spark, table):
    r = F.col("reaction")
    holes = reactions(table).withColumn("reaction", r.withField("id", F.when(F.col("reaction_pos") % 3 != 0, r["id"])).withField("conditions", F.when(F.col("reaction_pos") % 2 != 0, r["conditions"])).withField("ligands", F.when(F.size(r["ligands"]) > 0, r["ligands"])))
    made = holes.select("reaction_pos", canon.legacy_reaction(F.col("reaction"), F.col("reaction_pos")).alias("x"))
    size = lambda c, name: F.size(c).cast("long").alias(name)
    return made.select("reaction_pos", "x.id", size(F.col("x.substrates"), "n_substrates"), size(F.col("x.ligands"), "n_ligands"), size(F.col("x.conditions"), "n_conditions"))


@query(
    "reaction_digests",
    f"""WITH {_ORDERS} SELECT o.o_orderkey AS reaction_pos, count(*) FILTER (n = 1) AS n_substrates, least(8, count(*)) AS shown, any_value(kind) AS raw_reaction_type, nullif(any_value(y), '') AS "yield", any_value(degrees || ' C') AS temperature
      FROM o JOIN i ON i.o_orderkey = o.o_orderkey JOIN v ON v.o_orderkey = o.o_orderkey GROUP BY o.o_orderkey""",
)
def reaction_digests(spark, table):
    r = F.col("reaction")
    every = F.concat(*[r[f] for f in ("substrates", "products", "catalysts", "ligands", "other_components")])
    lines = table("lineitem").groupBy(F.col("l_orderkey").alias("reaction_pos")).agg(F.count("*").alias("_lines"))
    filled = reactions(table).join(lines, "reaction_pos").withColumn("_all", F.concat(every, F.transform(F.sequence(F.lit(1), F.greatest(F.col("_lines") - F.size(every), F.lit(1)).cast("int")), lambda i: F.when(i > 0, F.from_json(F.lit('{"symbol": "X"}'), schemas.COMPOUND)))))
    filled = filled.withColumn("_all", F.slice("_all", F.lit(1), F.col("_lines").cast("int")))
    told = filled.select("reaction_pos", canon.digest(r.withField("products", F.col("_all"))).alias("d"))
    size = lambda c: F.size(c).cast("long")
    return told.select("reaction_pos", size(F.col("d.substrates")).alias("n_substrates"), size(F.col("d.products")).alias("shown"), "d.raw_reaction_type", "d.targets.yield", F.try_element_at("d.conditions", F.lit("temperature")).alias("temperature"))


@query("question_texts", f"""WITH {_ORDERS}, s AS (SELECT o_orderkey, string_agg(p_name || ' (scaffold: ' || p_brand || ')', '; ' ORDER BY p_name, p_brand) AS t FROM i WHERE n = 1 GROUP BY 1)
    SELECT o_orderkey AS reaction_pos, 'Reaction type: ' || kind || '.' || chr(10) || 'Substrate combination: ' || coalesce(t, '') || '.' || chr(10) || 'Product(s): .' || chr(10) || 'Question: Which complete reaction conditions, including catalyst if applicable, are expected to give the best reported yield?' AS question FROM o LEFT JOIN s USING (o_orderkey)""")
def question_texts(spark, table):
    r = F.col("reaction")
    named = F.array_sort(F.transform(r["substrates"], lambda c: F.struct(c["name"].alias("name"), c["scaffold"].alias("scaffold"))))
    return reactions(table).select("reaction_pos", questions.question_text(r["reaction_type"], named, F.slice(named, 1, 0), m.YIELD_ONLY).alias("question"))


@query("option_distribution", "WITH q AS (SELECT l_orderkey, count(*) AS n_options FROM lineitem GROUP BY 1) SELECT n_options % 2 AS parity, count(*) AS n_questions, min(n_options) AS least, max(n_options) AS most FROM q GROUP BY 1")
def option_distribution(spark, table):
    q = table("lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n_options")).withColumn("parity", F.col("n_options") % 2)
    return questions.option_counts(q, "parity").select("parity", "n_questions", "least", "most")


@query("numbered_questions", "SELECT o_orderkey, 'Q1_' || lpad(n::VARCHAR, greatest(4, length(n::VARCHAR))::INTEGER, '0') AS id FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS n FROM orders)")
def numbered_questions(spark, table):
    return questions.numbered(table("orders").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"], "Q1").select("o_orderkey", "id")


@query(
    "suffixes_of_repeats",
    """WITH k AS (SELECT p_brand, p_partkey, CASE WHEN p_partkey % 11 = 0 THEN p_name || '_' || (2 + p_size % 3) ELSE p_name END AS name FROM part),
    r AS (SELECT *, row_number() OVER (PARTITION BY p_brand, name ORDER BY p_partkey) AS n FROM k),
    free AS (SELECT b.p_brand, b.name, i, row_number() OVER (PARTITION BY b.p_brand, b.name ORDER BY i) + 1 AS n FROM (SELECT p_brand, name, max(n) AS most FROM r GROUP BY ALL) b, range(2, 400) x(i) WHERE i < most + 40 AND NOT EXISTS (SELECT 1 FROM k WHERE k.p_brand = b.p_brand AND k.name = b.name || '_' || i))
    SELECT r.p_brand, p_partkey, r.name, CASE WHEN r.n = 1 THEN r.name ELSE r.name || '_' || i END AS unique_key FROM r LEFT JOIN free USING (p_brand, name, n)""",
)
def suffixes_of_repeats(spark, table):
    """Repeated keys among literal ones that look like suffixed ones."""
    name = F.when(F.col("p_partkey") % 11 == 0, F.concat("p_name", F.lit("_"), (F.col("p_size") % 3 + 2).cast("string"))).otherwise(F.col("p_name"))
    return dedupe.unique_suffixes(table("part").withColumn("name", name), ["p_brand"], ["p_partkey"], "name")


@query(
    "structure_identifiers",
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'iu' || p_partkey WHEN 1 THEN 'rn' || p_partkey ELSE p_name END AS text_value, CASE p_partkey % 4 WHEN 0 THEN 'iupac_name' WHEN 1 THEN 'resolved_name' ELSE 'name' END AS text_source,
       CASE p_partkey % 4 WHEN 0 THEN 'iu' || p_partkey WHEN 1 THEN 'rn' || p_partkey WHEN 2 THEN 'C=O' ELSE p_name END AS image_value, CASE p_partkey % 4 WHEN 0 THEN 'iupac_name' WHEN 1 THEN 'resolved_name' WHEN 2 THEN 'smiles' ELSE 'name' END AS image_source FROM part""",
)
def structure_identifiers(spark, table):
    k = F.col("p_partkey") % 4
    text = F.col("p_partkey").cast("string")
    given = F.struct(F.col("p_name").alias("name"), F.when(k == 0, F.concat(F.lit("iu"), text)).alias("iupac_name"), F.when(k == 1, F.concat(F.lit("rn"), text)).alias("resolved_name"), F.when(k == 2, "C=O").alias("smiles"))
    rows = table("part").select("p_partkey", F.from_json(F.to_json(given), schemas.COMPOUND).alias("c"))
    a, b = graph.structure_identifier(F.col("c"), "text"), graph.structure_identifier(F.col("c"), "image")
    return rows.select("p_partkey", a["value"].alias("text_value"), a["source"].alias("text_source"), b["value"].alias("image_value"), b["source"].alias("image_source"))


@query(
    "substrate_names_by_policy",
    """SELECT p_partkey, p_name AS resolved, CASE WHEN p_partkey % 3 = 0 THEN 'S' || p_partkey WHEN p_partkey % 2 = 0 THEN 'was ' || p_name ELSE p_name END AS original, CASE WHEN p_partkey % 5 = 0 THEN p_name WHEN p_partkey % 2 = 0 THEN 'was ' || p_name ELSE p_name END AS registry FROM part""",
)
def substrate_names_by_policy(spark, table):
    k, text = F.col("p_partkey"), F.col("p_partkey").cast("string")
    given = F.struct(
        F.col("p_name").alias("name"),
        F.concat(F.lit("S"), text).alias("symbol"),
        F.when(k % 2 == 0, F.concat(F.lit("was "), F.col("p_name"))).alias("original_name"),
        F.when(k % 5 == 0, "name_registry").alias("resolution_source"),
        F.struct(F.when(k % 3 == 0, "underspecified_series_label").alias("match_type")).alias("resolution_evidence"),
    )
    c = F.from_json(F.to_json(given), schemas.COMPOUND)
    policies = {"resolved": "resolved", "original": "original_if_available", "registry": "registry_if_resolved_else_original"}
    return table("part").select("p_partkey", c.alias("c")).select("p_partkey", *[graph.substrate_display_name(F.col("c"), p).alias(n) for n, p in policies.items()])


@query(
    "other_names",
    """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'rnn' WHEN 1 THEN 'benzyl ' || p_brand ELSE 'S1' END AS text_name, CASE p_partkey % 3 WHEN 0 THEN 'rnn' WHEN 1 THEN 'benzyl ' || p_brand ELSE 'S1' END AS image_name, CASE p_partkey % 3 WHEN 0 THEN 'rnn' WHEN 1 THEN '' ELSE 'S1' END AS filter_name FROM part""",
)
def other_names(spark, table):
    """Names that only the rarer identity fields give."""
    k = F.col("p_partkey") % 3
    given = F.struct(F.when(k == 0, "rnn").alias("resolved_name_normalized"), F.when(k == 1, F.concat(F.lit("benzyl "), F.col("p_brand"), F.lit(" (5 mmol)"))).alias("text"), F.when(k == 2, "S1").alias("symbol"))
    c = F.col("c")
    rows = table("part").select("p_partkey", F.from_json(F.to_json(given), schemas.COMPOUND).alias("c"))
    return rows.select("p_partkey", graph.display_name(c).alias("text_name"), graph.image_display_name(c).alias("image_name"), filters.compound_name(c).alias("filter_name"))


# --- questions and alignments ---------------------------------------------------------------------------------------
_Q1 = """r AS (SELECT p_brand AS source_paper, p_type AS kind, p_size AS cond, p_partkey::VARCHAR AS k, p_partkey % 7 <> 0 AS e, CASE WHEN p_partkey % 7 <> 0 THEN (p_partkey % 80)::DOUBLE END AS y FROM part),
sizes AS (SELECT source_paper, kind, count(*) AS n, count(*) FILTER (e) AS n_eligible FROM r GROUP BY ALL),
m AS (SELECT source_paper, kind, cond, count(DISTINCT y) AS outcomes, count(*) AS n, min(k) AS k, arg_min(y, k) AS y FROM r WHERE e GROUP BY ALL),
g AS (SELECT source_paper, kind, count(*) AS n_options, max(y) AS best, list(k ORDER BY y DESC, k) AS ranked FROM m WHERE outcomes = 1 GROUP BY ALL),
j AS (SELECT s.*, coalesce(n_options, 0) AS n_options, best, ranked, CASE WHEN n_eligible < 2 THEN 'insufficient_objective_options' WHEN coalesce(n_options, 0) < 2 THEN 'insufficient_distinct_conditions' END AS reason FROM sizes s LEFT JOIN g USING (source_paper, kind))"""


def _screens(table):
    """Reactions of parts: one paper a brand, one kind a type, the size as solvent, a yield for most."""
    k = F.col("p_partkey")
    of = lambda name: F.array(F.from_json(F.to_json(F.struct(name.alias("name"))), schemas.COMPOUND))
    given = F.struct(
        F.col("p_type").alias("reaction_type"),
        of(F.lit("S")).alias("substrates"),
        of(F.lit("P")).alias("products"),
        *[F.array().cast(f"array<{schemas.COMPOUND}>").alias(r) for r in ("catalysts", "ligands", "other_components", "additives", "reagents")],
        F.create_map(F.lit("solvent"), F.array(F.struct(F.lit(None).cast("int").alias("step"), F.col("p_size").cast("string").alias("value")))).alias("conditions"),
        F.struct(F.when(k % 7 != 0, F.concat((k % 80).cast("string"), F.lit("%"))).alias("yield"), *[F.lit(None).cast("string").alias(x) for x in ("ee", "er", "dr")]).alias("targets"),
    )
    return table("part").select(F.col("p_brand").alias("source_paper"), k.alias("reaction_pos"), given.alias("reaction"))


@query("screen_questions", f"WITH {_Q1} SELECT source_paper, kind AS reaction_type, n_options, best, [x.k FOR x IN (SELECT list({{'k': k, 'y': y}} ORDER BY k) FROM m WHERE m.source_paper = j.source_paper AND m.kind = j.kind AND outcomes = 1) IF x.y = best] AS gold, ranked, n_options >= 3 AS top3 FROM j WHERE reason IS NULL")
def screen_questions(spark, table):
    found, _ = questions.condition_questions(_screens(table), m.YIELD_ONLY)
    return found.select("source_paper", "reaction_type", "n_options", "best", "gold", "ranked", "top3")


@query("screen_review", f"WITH {_Q1} SELECT source_paper, kind AS reaction_type, reason, n FROM j WHERE reason IS NOT NULL UNION ALL SELECT source_paper, kind, 'duplicate_public_conditions_conflicting_results', n FROM m WHERE outcomes > 1")
def screen_review(spark, table):
    _, review = questions.condition_questions(_screens(table), m.YIELD_ONLY)
    return review.select("source_paper", "reaction_type", "reason", "n")


_ENTITIES = """t AS (SELECT 't' || p_partkey AS text_id, p_brand AS paper, p_name AS name, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE '' END AS iupac, 's' || p_size AS symbol, p_type AS token FROM part WHERE p_partkey % 2 = 0),
i AS (SELECT 'i' || p_partkey AS image_id, p_brand AS paper, p_name AS name, CASE WHEN p_partkey % 5 = 0 THEN p_name ELSE '' END AS iupac, CASE WHEN p_partkey % 11 = 0 THEN 'C=O' ELSE '' END AS smiles, 's' || p_size AS symbol, p_type AS token FROM part WHERE p_partkey % 2 = 1),
same AS (SELECT DISTINCT text_id, image_id FROM t JOIN i USING (paper, iupac) WHERE iupac <> ''),
known AS (SELECT paper, symbol, min(text_id) AS text_id FROM t GROUP BY ALL HAVING count(DISTINCT lower(name)) = 1),
resolved AS (SELECT known.text_id, image_id FROM i JOIN known USING (paper, symbol) WHERE iupac = '' AND smiles = ''),
rest AS (SELECT * FROM i WHERE iupac = '' AND image_id NOT IN (SELECT image_id FROM same UNION SELECT image_id FROM resolved)),
weak AS (SELECT text_id, image_id, min(CASE WHEN t.symbol = r.symbol THEN 0 WHEN t.token = r.token THEN 1 ELSE 2 END) AS rank FROM rest r JOIN t ON t.paper = r.paper AND (t.symbol = r.symbol OR t.token = r.token OR t.name = r.name) GROUP BY ALL)"""


@query(
    "entity_alignments",
    f"""WITH {_ENTITIES} SELECT text_id, image_id, 'SAME_AS' AS relationship, 'iupac' AS method, 'high' AS confidence FROM same UNION ALL SELECT text_id, image_id, 'NAME_RESOLVED_BY', 'symbol', 'medium' FROM resolved
    UNION ALL SELECT text_id, image_id, 'CANDIDATE_SAME_AS', CASE rank WHEN 0 THEN 'symbol' WHEN 1 THEN 'token' ELSE 'name' END, 'low' FROM weak""",
)
def entity_alignments(spark, table):
    k = F.col("p_partkey")

    def side(rest: int, letter: str, step: int, smiles):
        iupac = F.when(k % step == 0, F.col("p_name")).otherwise("")
        return table("part").filter(k % 2 == rest).select(F.concat(F.lit(letter), k.cast("string")).alias("entity_id"), F.col("p_brand").alias("source_paper"), F.lit("products").alias("field"), F.col("p_name").alias("name"), iupac.alias("iupac"), smiles.alias("smiles"), F.concat(F.lit("s"), F.col("p_size").cast("string")).alias("symbol"), F.col("p_type").alias("token"))

    return graph.align(side(0, "t", 3, F.lit("")), side(1, "i", 5, F.when(k % 11 == 0, "C=O").otherwise("")))


# --- texts ----------------------------------------------------------------------------------------------------------
_FORMULAS = "CASE doc_id % 4 WHEN 0 THEN 'C6H12O6' WHEN 1 THEN 'C 2 H6 O' WHEN 2 THEN 'Na2CO3 and C7H8' ELSE 'X9Zz3 C99H2' END"


@query(
    "missing_formulas",
    """SELECT doc_id, formula FROM (SELECT doc_id, unnest(CASE doc_id % 4 WHEN 0 THEN ['C6H12O6'] WHEN 1 THEN ['C2H6O'] WHEN 2 THEN ['Na2CO3', 'C7H8'] ELSE []::VARCHAR[] END) AS formula FROM documents WHERE doc_id % 5 <> 0)
       WHERE NOT (doc_id % 3 = 0 AND formula IN ('C6H12O6', 'C7H8'))""",
)
def missing_formulas(spark, table):
    """Formulas of a reference text that a page lacks; every fifth page is one of spectra."""
    d = table("documents").select("doc_id")
    own = F.concat(F.when(F.col("doc_id") % 3 == 0, "with C6 H12\nO6 or C7H8.").otherwise("none"), F.when(F.col("doc_id") % 5 == 0, " NMR Spectra").otherwise(""))
    return filters.missing_formulas(d.select("doc_id", own.alias("text")), d.select("doc_id", F.concat(F.lit("of "), F.expr(_FORMULAS), F.lit(", he said")).alias("text")), "doc_id")


@query("formula_hits_in_text", "SELECT c_custkey, (1 + c_custkey % 2)::INTEGER AS line_no, CASE c_custkey % 3 WHEN 0 THEN 'alkali_carbonate_gap' WHEN 1 THEN 'chlorinated_solvent_gap' ELSE 'ether_gap' END AS pattern, CASE c_custkey % 3 WHEN 0 THEN 'Na CO' WHEN 1 THEN 'CH Cl' ELSE 'Et O' END AS match FROM customer")
def formula_hits_in_text(spark, table):
    k = F.col("c_custkey")
    hit = F.when(k % 3 == 0, "dried over Na CO 3").when(k % 3 == 1, "in CH Cl 2").otherwise("with Et O twice")
    return filters.broken_formulas(table("customer").select("c_custkey", F.concat(F.when(k % 2 == 1, "a line\n").otherwise(""), hit).alias("text")), "c_custkey")


@query("joined_lines", "SELECT p_partkey, 'the ' || p_name || ' is recrystallised' || chr(10) || chr(10) || 'twice ' || p_type || ' again' AS text FROM part")
def joined_lines(spark, table):
    pages = F.array(F.concat(F.lit("the "), F.col("p_name"), F.lit(" is recrys-\ntallised\n")), F.concat(F.lit("twice\n"), F.col("p_type")), F.lit("again"))
    return table("part").select("p_partkey", t.join_pages(pages).alias("text"))


@query(
    "target_cues",
    "SELECT c_custkey, c_custkey % 5 < 3 AS cue FROM customer",
)
def target_cues(spark, table):
    k, n = F.col("c_custkey"), (F.col("c_custkey") % 90).cast("string")
    said = F.when(k % 5 == 0, F.concat(n, F.lit("% (isolated) yield"))).when(k % 5 == 1, F.concat(F.lit("er = "), n, F.lit(":3"))).when(k % 5 == 2, F.concat(F.lit(">"), n, F.lit(":1 dr"))).when(k % 5 == 3, F.concat(n, F.lit("% conversion"))).otherwise("a good yield")
    return table("customer").select("c_custkey", m.target_cue(F.concat(F.lit("gave "), F.col("c_name"), F.lit(" in "), said, F.lit(" overall"))).alias("cue"))


@query("quick_classes", "SELECT p_partkey, CASE WHEN p_partkey % 4 < 2 OR p_partkey % 4 = 2 AND length(p_name || ' derivative') < 20 THEN 'Q2' END AS class FROM part")
def quick_classes(spark, table):
    k = F.col("p_partkey") % 4
    name = F.when(k == 0, F.concat(F.lit("3"), F.lit("a"))).when(k == 1, "Ketone Derivative").when(k == 2, F.concat("p_name", F.lit(" derivative"))).otherwise(F.concat(F.lit("a long name of "), F.col("p_name")))
    return table("part").select("p_partkey", t.quick_class(name).alias("class"))


@query(
    "free_conditions",
    """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '50%' ELSE c_nationkey || '%' END AS "yield", c_nationkey || ':1' AS er, CASE WHEN c_custkey % 3 = 0 THEN 'DMF' ELSE lower(c_mktsegment) END AS solvent, c_nationkey || ' C' AS temperature, '12 h' AS time FROM customer""",
)
def free_conditions(spark, table):
    """What a free text says fills only what is empty."""
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    said = F.concat(F.lit("yield: "), n, F.lit("%, er "), n, F.lit(":1; solvent: "), F.lower("c_mktsegment"), F.lit("; "), n, F.lit(" C, 12 h"))
    none = F.lit(None).cast("string")
    targets = F.struct(F.when(k % 2 == 0, "50%").alias("yield"), none.alias("ee"), none.alias("er"), none.alias("dr"))
    conditions = F.map_from_entries(F.filter(F.array(F.struct(F.lit("solvent").alias("key"), F.when(k % 3 == 0, "DMF").alias("value"))), lambda e: e["value"].isNotNull()))
    out = table("customer").select("c_custkey", said.alias("said"), targets.alias("t"), conditions.alias("c")).select("c_custkey", canon.free_condition(F.col("said"), F.col("t"), F.col("c")).alias("x"))
    return out.select("c_custkey", "x.targets.yield", "x.targets.er", *[F.col("x.conditions")[c].alias(c) for c in ("solvent", "temperature", "time")])


@query("unique_appends", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN ['a', 'b', c_mktsegment] ELSE ['a', 'b'] END AS names FROM customer")
def unique_appends(spark, table):
    one = lambda name: F.struct(name.alias("name"), F.lit("1 g").alias("amount"))
    have = F.array(one(F.lit("a")), one(F.lit("b")))
    new = F.array(one(F.lit("b")), one(F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment"))), one(F.lit("")), one(F.lit("a")))
    return table("customer").select("c_custkey", F.transform(canon.append_unique(have, new), lambda c: c["name"]).alias("names"))


@query("procedure_parts", "SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'GeneralProcedureA_3a-3k' ELSE s_name END AS gp_key, CASE WHEN s_suppkey % 2 = 0 THEN 'Procedure A (for products 3a-3k): mix ' || s_name ELSE 'Procedure A (for products 3a-3k): mix' END AS text FROM supplier UNION ALL SELECT s_suppkey, 'GeneralProcedureB_4a-4c', '2) Procedure B (for the compounds 4a - 4c): heat' FROM supplier WHERE s_suppkey % 2 = 0")
def procedure_parts(spark, table):
    text = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("Intro.\nProcedure A (for products 3a-3k): mix "), F.col("s_name"), F.lit("\n2) Procedure B (for the compounds 4a - 4c): heat"))).otherwise("Procedure A (for products 3a-3k): mix")
    return procedures.embedded_procedures(table("supplier").select("s_suppkey", F.col("s_name").alias("gp_key"), text.alias("text"))).select("s_suppkey", "gp_key", "text")


@query("label_texts", "SELECT p_partkey, p_name AS name, (p_partkey % 90) || 'b' AS symbol, p_partkey % 2 = 0 AS lacks, p_name AS stripped, 'unclear' AS fenced FROM part")
def label_texts(spark, table):
    """Labels behind names, labels that lack letters, names among amounts, fenced answers."""
    n = (F.col("p_partkey") % 90).cast("string")
    split = t.trailing_symbol(F.concat("p_name", F.lit(" ("), n, F.lit("b)")))
    return table("part").select(
        "p_partkey",
        split["name"].alias("name"),
        split["symbol"].alias("symbol"),
        t.underspecified_label(n, F.when(F.col("p_partkey") % 2 == 0, F.concat(n, F.lit("k"))).otherwise(F.lit("x"))).alias("lacks"),
        t.strip_amounts(F.concat("p_name", F.lit(" (0.5 mmol, 20 mg), 3 equiv"))).alias("stripped"),
        t.strip_fence(F.lit("```json\nunclear\n```")).alias("fenced"),
    )


@query("labelled_amounts", "SELECT c_custkey, lower(c_mktsegment) AS solvent, c_nationkey || ' mmol' AS amount, '(' || c_nationkey || ')x' AS peeled, [1, 12] AS pages FROM customer")
def labelled_amounts(spark, table):
    n = F.col("c_nationkey").cast("string")
    return table("customer").select(
        "c_custkey",
        m.labelled_value(F.concat(F.lit("with solvent: "), F.lower("c_mktsegment"), F.lit(", dry")), "solvent").alias("solvent"),
        m.extract_amount(F.concat(F.lit("used "), n, F.lit(" mmol of it"))).alias("amount"),
        m.peel_parentheses(F.concat(F.lit("(((("), n, F.lit(")x)))"))).alias("peeled"),
        t.marked_pages(F.lit("--- Page 12 ---\ntext\n--- Page 1 ---\n--- Page 0 ---")).alias("pages"),
    )


@query("condition_checks", f"""WITH {_ORDERS} SELECT o_orderkey AS reaction_pos, solvent IS NOT NULL OR degrees IS NOT NULL AS valid, solvent IS NOT NULL OR degrees IS NOT NULL OR EXISTS (SELECT 1 FROM i WHERE i.o_orderkey = o.o_orderkey AND n IN (3, 4, 6)) AS visible,
      coalesce((SELECT list_sort(list(p_name)) FROM i WHERE i.o_orderkey = o.o_orderkey AND n = 1), []) AS substrates, coalesce((SELECT list_sort(list(p_brand)) FROM i WHERE i.o_orderkey = o.o_orderkey AND n = 1), []) AS scaffolds,
      (SELECT CASE WHEN count(DISTINCT p_brand) = 1 THEN min(p_brand) || ' product' END FROM i WHERE i.o_orderkey = o.o_orderkey AND n = 2) AS class FROM o JOIN v USING (o_orderkey)""".replace("o_orderkey AS reaction_pos", "o.o_orderkey AS reaction_pos"))
def condition_checks(spark, table):
    r = F.col("reaction")
    return reactions(table).select("reaction_pos", F.coalesce(filters.has_valid_condition(r["conditions"]), F.lit(False)).alias("valid"), questions.has_visible_condition(r).alias("visible"), questions.substrate_key(r["substrates"]).alias("substrates"), questions.scaffold_key(r["substrates"]).alias("scaffolds"), validation.scaffold_class(r["products"]).alias("class"))


@query(
    "compound_marks",
    """SELECT p_partkey, p_partkey % 2 = 0 AS uncertain, p_partkey % 3 = 0 AS symbol, CASE p_partkey % 3 WHEN 0 THEN [1] ELSE [0, 1] END AS specific, ['a=S' || p_partkey] AS hidden, p_partkey % 4 < 2 AS covered FROM part""",
)
def compound_marks(spark, table):
    k, text = F.col("p_partkey"), F.col("p_partkey").cast("string")
    name = F.when(k % 3 == 0, "4ab").otherwise(F.col("p_name"))
    of = lambda n, s=None: F.from_json(F.to_json(F.struct(n.alias("name"), (F.lit(None).cast("string") if s is None else s).alias("symbol"))), schemas.COMPOUND)
    rows = table("part").select("p_partkey", "p_name", name.alias("name"), F.array(of(name), of(F.col("p_name")), of(F.lit("Product")), of(F.lit(None).cast("string"))).alias("products"), F.array(of(F.lit(" a "), F.concat(F.lit("S"), text)), of(F.lit("b"))).alias("others"))
    reagent = F.when(k % 4 == 0, F.concat("p_name", F.lit("; more"))).when(k % 4 == 1, F.upper("p_name")).otherwise("absent")
    return rows.select(
        "p_partkey",
        t.is_uncertain(F.when(k % 2 == 0, F.concat("p_name", F.lit(", Please Check"))).otherwise(F.col("p_name"))).alias("uncertain"),
        t.looks_like_symbol(F.col("name")).alias("symbol"),
        validation.specific_products(F.col("products")).alias("specific"),
        validation.hidden_symbols(F.col("others")).alias("hidden"),
        validation.covered_by_context(reagent, F.array(F.concat(F.lit("some "), F.col("p_name")))).alias("covered"),
    )


@query("section_words", "SELECT p_partkey, lower(p_name) AS title, p_partkey % 2 = 0 AS heading, 'a: ' || p_brand || chr(10) || 'b: ' || p_type AS template FROM part")
def section_words(spark, table):
    line = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("3. "), F.upper("p_name"))).otherwise(F.concat("p_name", F.lit(" is what this long sentence is about, and it goes on and on")))
    return table("part").select(
        "p_partkey",
        procedures.section_title(F.concat(F.lit("IV.2) "), F.upper("p_name"), F.lit(" :. "))).alias("title"),
        procedures.is_heading(line, F.split(F.lower("p_name"), " ")).alias("heading"),
        procedures.render_template(F.create_map(F.lit("b"), F.col("p_type"), F.lit("a"), F.col("p_brand"))).alias("template"),
    )


@query(
    "shaped_reactions",
    """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN '90%' WHEN 1 THEN c_nationkey || '%' END AS "yield", c_nationkey || ':1' AS er, CASE c_custkey % 2 WHEN 0 THEN c_nationkey || ' mL' ELSE '9 mL' END AS solvent_amount, c_mktsegment || '; DMF' AS solvent, 2 AS steps,
       CASE c_custkey % 4 WHEN 0 THEN 'produced_not_before_consumed' WHEN 1 THEN 'consumed_after_last_step' WHEN 2 THEN 'repeated_intermediate' END AS step_error, CASE c_custkey % 2 WHEN 0 THEN 2 ELSE 1 END AS score FROM customer""",
)
def shaped_reactions(spark, table):
    """Outcomes lifted and cleaned, conditions of one step, amounts under one key, steps and what is wrong with them."""
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    none = F.lit(None).cast("string")
    inside = F.struct(F.when(k % 3 == 0, "((90%))").alias("yield"), none.alias("ee"), F.concat(F.lit("er = "), n, F.lit(":1")).alias("er"), F.lit("null").alias("dr"))
    beside = F.struct(F.when(k % 3 == 1, F.concat(n, F.lit("%"))).otherwise("not reported").alias("yield"), none.alias("ee"), none.alias("er"), none.alias("dr"))
    value = lambda *vs: F.array(*[F.struct(F.lit(i + 1).alias("step"), v.alias("value")) for i, v in enumerate(vs)])
    conditions = F.map_concat(F.create_map(F.lit("volume"), value(F.concat(n, F.lit(" mL"))), F.lit("solvent"), value(F.col("c_mktsegment"), F.lit(" DMF"))), F.when(k % 2 != 0, F.create_map(F.lit("solvent_amount"), value(F.lit("9 mL")))).otherwise(F.create_map(F.lit("concentration"), value(F.lit(" ")))))
    made = lambda name, a, b: F.struct(F.lit(name).alias("name"), none.alias("symbol"), F.lit(a).alias("produced_in_step"), F.lit(b).alias("consumed_in_step"))
    inter = F.when(k % 4 == 0, F.array(made("I", 2, 2))).when(k % 4 == 1, F.array(made("I", 1, 7))).when(k % 4 == 2, F.array(made("I", 1, 2), made("i", 1, 2))).otherwise(F.array(made("I", 1, 2)))
    rows = dealt(table("customer")).select("c_custkey", inside.alias("inside"), beside.alias("beside"), conditions.alias("conditions"), inter.alias("intermediates"), F.lit(None).cast("int").alias("step_count"))
    r = rows.select("c_custkey", canon.lift_targets(F.col("inside"), F.col("beside")).alias("t"), canon.condition_amounts(F.col("conditions")).alias("c"), F.struct("conditions", F.filter("intermediates", lambda i: i["consumed_in_step"] < 7).alias("intermediates"), "step_count").alias("r"), F.struct("intermediates").alias("s"), "conditions")
    r = r.select("*", canon.clean_targets(F.col("t")).alias("cleaned"), canon.single_step(F.col("c")).alias("one"), canon.inheritance({"amount": F.map_contains_key(F.col("c"), "solvent_amount"), "air": F.map_contains_key(F.col("c"), "atmosphere"), "even": F.col("c_custkey") % 2 == 0}).alias("inherited"))
    return r.select(
        "c_custkey", "cleaned.yield", "cleaned.er", F.col("c")["solvent_amount"][0]["value"].alias("solvent_amount"), F.col("one")["solvent"][0]["value"].alias("solvent"),
        canon.step_count(F.col("r"), ()).alias("steps"), canon.step_error(F.col("s"), F.lit(2)).alias("step_error"), F.col("inherited.score").alias("score"),
    )


@query("missed_targets", "SELECT c_custkey, CASE WHEN c_custkey % 4 IN (0, 1) AND c_custkey % 3 <> 0 THEN ['r1', '<missing id>'] END AS missed FROM customer")
def missed_targets(spark, table):
    k = F.col("c_custkey")
    none = F.lit(None).cast("string")
    targets = lambda y: F.struct(y.alias("yield"), none.alias("ee"), F.lit("").alias("er"), none.alias("dr"))
    one = lambda i, product, y: F.struct(i.alias("id"), F.array(F.struct(product.alias("name"))).alias("products"), targets(y).alias("targets"))
    some = F.array(one(F.lit("r1"), F.col("c_name"), none), one(F.lit("r2"), F.col("c_name"), F.lit("5%")), one(F.lit("r3"), F.lit(""), none), one(none, F.lit("x"), none))
    mode = F.when(k % 4 == 0, "gp").when(k % 4 == 1, "mixed").otherwise("plain")
    return table("customer").select("c_custkey", validation.missed_targets(F.when(k % 3 != 0, "gave 5% yield").otherwise("gave much"), mode, some).alias("missed"))


@query("image_batch", "SELECT count(*) AS images, count(*) FILTER (c_custkey % 3 = 0) AS ok, count(*) FILTER (c_custkey % 3 <> 0) AS failed, max(c_nationkey)::DOUBLE AS longest, sum(c_nationkey)::DOUBLE AS seconds FROM customer")
def image_batch(spark, table):
    return reports.batch_summary(table("customer").select(F.when(F.col("c_custkey") % 3 == 0, "ok").otherwise("error").alias("status"), F.col("c_nationkey").cast("double").alias("image_elapsed_seconds")))


@query("resolution_violations", "SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'ambiguous_symbol' WHEN p_partkey % 2 = 0 THEN 'had_a_name' WHEN p_partkey % 3 = 0 THEN 'uncertain_text' WHEN p_partkey % 7 = 0 THEN 'not_a_compound' END AS violation FROM part WHERE p_size % 5 = 0 OR p_partkey % 2 = 0 OR p_partkey % 3 = 0 OR p_partkey % 7 = 0")
def resolution_violations(spark, table):
    k, symbol = F.col("p_partkey"), F.concat(F.lit("S"), F.col("p_size").cast("string"))
    rows = table("part").select("p_partkey", F.lit("p").alias("scope"), symbol.alias("symbol"), F.when(k % 2 == 0, F.col("p_name")).otherwise(F.lower(symbol)).alias("name"), F.when(k % 3 == 0, "not sure of it").otherwise("sure").alias("text"), F.when(k % 7 == 0, "conditions").otherwise("products").alias("field"))
    ambiguous = table("part").filter("p_size % 5 = 0").select(F.lit("p").alias("scope"), symbol.alias("symbol"))
    return validation.resolution_violations(rows, ambiguous, ["scope"]).select("p_partkey", "violation")


# --- reports --------------------------------------------------------------------------------------------------------
@query("split_report", "SELECT CASE WHEN grouping(n_name) = 0 THEN n_name END AS paper, count(*) AS n, count(*) FILTER (c_custkey % 3 = 0) AS q1, count(*) FILTER (c_custkey % 3 = 1) AS q2, count(*) FILTER (c_custkey % 3 = 2) AS unclassified, count(DISTINCT c_mktsegment) AS names FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ROLLUP (n_name)")
def split_report(spark, table):
    k = F.col("c_custkey") % 3
    classes = table("customer").filter(k < 2).select("c_custkey", F.when(k == 0, "Q1").otherwise("Q2").alias("class"))
    rows = table("customer").join(table("nation"), F.col("n_nationkey") == F.col("c_nationkey")).select("c_custkey", F.col("n_name").alias("paper"), "c_mktsegment")
    return reports.split_report(rows, classes, "c_custkey", "paper", "c_mktsegment")


@query(
    "enrichment_stats",
    """SELECT count(*) AS compounds, count(*) FILTER (k = 0) AS without_name, count(*) FILTER (k <> 0) AS with_name, count(DISTINCT CASE WHEN k <> 0 THEN p_name END) AS distinct_names, count(*) FILTER (k <> 0 AND h) AS cache_hits, count(*) FILTER (k <> 0 AND NOT h) AS cache_misses,
       count(*) FILTER (k <> 0 AND NOT h AND p) AS parsed, count(*) FILTER (k <> 0 AND NOT h AND NOT p AND p_size % 2 = 0) AS failed, count(*) FILTER (k <> 0 AND NOT h AND NOT p AND p_size % 2 = 1) AS pending, count(*) FILTER (k <> 0 AND (h OR p)) AS enriched
       FROM (SELECT *, p_partkey % 6 AS k, p_partkey % 4 = 0 AS h, p_partkey % 3 = 0 AS p FROM part)""",
)
def enrichment_stats(spark, table):
    k = F.col("p_partkey")
    rows = table("part").select(F.when(k % 6 != 0, F.col("p_name")).otherwise("").alias("name"), (k % 4 == 0).alias("hit"), (k % 3 == 0).alias("parsed"), F.when((k % 3 != 0) & (F.col("p_size") % 2 == 0), "no answer").otherwise("").alias("error"))
    return reports.enrichment_stats(rows)


@query("run_summary", "SELECT CASE WHEN grouping(event_type) = 0 THEN event_type END AS stage, count(DISTINCT user_id) AS papers, count(DISTINCT user_id) FILTER (event_id % 3 = 0) AS ok, count(DISTINCT user_id) FILTER (event_id % 3 = 1) AS failed, count(DISTINCT user_id) FILTER (event_id % 3 = 2) AS skipped, sum(event_id % 60)::DOUBLE AS seconds FROM events GROUP BY ROLLUP (event_type)")
def run_summary(spark, table):
    k = F.col("event_id") % 3
    rows = table("events").select(F.col("user_id").alias("paper"), F.col("event_type").alias("stage"), F.when(k == 0, "ok").when(k == 1, "failed").otherwise("skipped").alias("status"), (F.col("event_id") % 60).cast("double").alias("seconds"))
    return reports.run_summary(rows)


@query("procedure_summary", "SELECT s_nationkey AS paper, count(*) AS procedures, count(*) FILTER (s_suppkey % 3 = 0) AS valid, count(*) FILTER (s_suppkey % 3 = 1) AS invalid, count(*) FILTER (s_suppkey % 3 = 2) AS error FROM supplier GROUP BY 1")
def procedure_summary(spark, table):
    k = F.col("s_suppkey") % 3
    texts = table("supplier").filter(k != 1).select(F.col("s_suppkey").alias("gp_key"), F.lit(1).alias("pos"))
    templates = table("supplier").filter(k < 2).select(F.col("s_suppkey").alias("gp_key"), (F.col("s_suppkey") % 3 == 0).alias("valid"))
    log = procedures.gp_log(texts, templates, table("supplier").select(F.col("s_suppkey").alias("gp_key")))
    return reports.gp_summary(log.join(table("supplier").select(F.col("s_suppkey").alias("gp_key"), F.col("s_nationkey").alias("paper")), "gp_key"))
