"""Reactions to edges and back, and the alignment of entities."""

from pyspark.sql import functions as F

from retort import schemas
from retort.functions.vocab import EDGE_COLUMNS
from retort.operators import graph, questions


def reactions(spark, *bodies):
    import json

    rows = spark.createDataFrame([("P", i, json.dumps(b)) for i, b in enumerate(bodies)], "source_paper string, reaction_pos int, j string")
    return rows.select("source_paper", "reaction_pos", F.from_json("j", schemas.REACTION).alias("reaction"))


ONE = {"id": "r1", "source_pages": [2, 5], "substrates": [{"name": "A", "amount": "1 mmol"}], "products": [{"name": "B", "scaffold": "arene"}], "conditions": {"solvent": [{"value": "THF"}], "solvent_amount": [{"value": "2 mL"}], "temperature": [{"value": "25 °C"}], "time": [{"value": "1 h"}]}, "targets": {"yield": "90%"}}
TWO = {
    "id": "r2",
    "step_count": 2,
    "substrates": [{"name": "A", "step": 1}, {"symbol": "2b", "step": 2}, {}],
    "products": [{"name": "C", "step": 2}],
    "intermediates": [{"name": "I", "produced_in_step": 1, "consumed_in_step": 2}, {}],
    "conditions": {"solvent": [{"step": 1, "value": "THF"}], "solvent_amount": [{"step": 1, "value": "2 mL"}, {"step": 2, "value": "25 mL"}], "time": [{"step": 2, "value": "3 h"}]},
    "targets": {"ee": "88%"},
}


def folded(spark, *bodies):
    edges = graph.text_edges(reactions(spark, *bodies))
    return {r.location: r for r in graph.fold_edges(edges.withColumn("pos", F.xxhash64(*EDGE_COLUMNS))).collect()}


def test_reactions_are_shuffled_once_and_not_their_edges(spark):
    """Repeats of a node are merged, also where outcomes differ, and folding needs no shuffle of its own."""
    other = {**ONE, "targets": {"yield": "5%"}, "ligands": [{"name": "L"}]}
    edges = graph.text_edges(reactions(spark, ONE, ONE, other))
    rows = [tuple(r) for r in edges.collect()]
    assert len(rows) == len(set(rows)) and {r[EDGE_COLUMNS.index("yield")] for r in rows} == {"90%", "5%"}
    plan = graph.fold_edges(edges.withColumn("pos", F.struct("relationship", "step", "y_name")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_single_step(spark):
    row = folded(spark, ONE)["r1; PDF pages: 2, 5"]
    assert (row.substrate, row["product"], row.solvent, row.conditions, row["yield"], row.ee) == ("A (1 mmol)", "B", "THF (2 mL)", "temp: 25 °C; time: 1 h", "90%", "")


def test_steps_intermediates_and_spare_amounts(spark):
    row = folded(spark, TWO)["r2"]
    assert row.intermediate == "step1: I"
    assert row.solvent == "step1: THF (2 mL); step2: solvent_amount: 25 mL"
    assert row.conditions == "step2: time: 3 h"
    assert row.substrate == "unknown; step1: A; step2: 2b"
    assert row.ee == "88%"


def test_edges_are_distinct_and_complete(spark):
    edges = graph.text_edges(reactions(spark, ONE, ONE))
    assert edges.columns == list(EDGE_COLUMNS)
    assert edges.count() == edges.distinct().count()
    assert {r.relationship for r in edges.collect()} == {"REPORTED_IN", "OF_TYPE", "USES_SOLVENT", "HAS_CONDITION", "USES_SUBSTRATE", "PRODUCES", "HAS_SCAFFOLD"}
    assert edges.filter("y_name = ''").count() == 0


def test_substrate_policies(spark):
    row = reactions(spark, {"substrates": [{"name": "N", "original_name": "O", "symbol": "3", "resolution_source": "name_registry", "registry_match_status": "exact"}]})
    c = F.col("reaction.substrates")[0]
    got = row.select(*[graph.substrate_display_name(c, p) for p in ("resolved", "original_if_available", "registry_if_resolved_else_original")]).first()
    assert tuple(got) == ("N", "O", "N")


def test_alignment(spark):
    columns = "entity_id string, source_paper string, field string, name string, iupac string, smiles string, symbol string, token string"
    text = spark.createDataFrame([("t1", "P", "products", "B", "benzene", "", "1a", "B"), ("t2", "P", "products", "C", "", "", "2a", "C"), ("t3", "P", "products", "D", "", "", "3a", "D"), ("t4", "P", "products", "E", "", "", "3a", "E")], columns)
    image = spark.createDataFrame([("i1", "P", "products", "x", "benzene", "", "", ""), ("i2", "P", "products", "y", "", "", "2a", "y"), ("i3", "P", "products", "z", "", "", "3a", "z"), ("i4", "Q", "products", "B", "", "", "1a", "B")], columns)
    found = {(r.text_id, r.image_id, r.relationship) for r in graph.align(text, image).collect()}
    assert found == {("t1", "i1", "SAME_AS"), ("t2", "i2", "NAME_RESOLVED_BY"), ("t3", "i3", "CANDIDATE_SAME_AS"), ("t4", "i3", "CANDIDATE_SAME_AS")}
    edges = graph.alignment_edges(spark.createDataFrame([("SAME_AS", "B", "x", "P"), ("NAME_RESOLVED_BY", "C", "y", "P"), ("CANDIDATE_SAME_AS", "D", "z", "P")], "relationship string, text_name string, image_name string, pdf_name string"))
    assert {(r.x_name, r.relationship, r.y_name) for r in edges.collect()} == {("B", "SAME_AS", "x"), ("y", "NAME_RESOLVED_BY", "C")}


def test_legacy_edges_shuffle_triples_and_no_reactions(spark):
    reaction = F.from_json(F.lit('{"id": "r1", "substrates": [{"name": "a", "step": 1, "amount": "1 g"}]}'), schemas.REACTION)
    rows = spark.range(2).select(F.lit("p").alias("source_paper"), F.col("id").alias("reaction_pos"), reaction.alias("reaction"))
    made = graph.legacy_edges(rows)
    assert [tuple(x) for x in made.collect()] == [("p:r1", "USES_SUBSTRATE", "a", 1, "1 g")]
    assert "min_by(reaction" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_questions_aggregate_stored_rows(spark):
    rows = reactions(spark, {"id": "r1", "reaction_type": "x", "substrates": [{"name": "a", "scaffold": "s"}], "products": [{"name": "b"}]})
    for ask in (questions.condition_questions, questions.substrate_questions):
        assert "from_json" not in ask(rows, None)[1]._jdf.queryExecution().optimizedPlan().toString()


def test_distinct_edges_are_shuffled_by_reaction(spark):
    """Edges of a reaction go as one set, those of other nodes each by itself; nulls are values, and repeats go."""
    base = dict.fromkeys(EDGE_COLUMNS, "")
    rows = [{**base, "x_name": "TextReaction:P:1", "x_type": "Reaction", "relationship": "PRODUCES", "y_name": y, "product_amount": a} for y, a in (("a", "1"), ("a", "1"), ("a", None), ("b", "1"), ("", "1"))]
    rows += [{**base, "x_name": "c", "x_type": x, "relationship": "SAME_AS", "y_name": f"d{i % 3}"} for i in range(6) for x in ("Compound", None)]
    edges = spark.createDataFrame([tuple(r[c] for c in EDGE_COLUMNS) for r in rows], ", ".join(f"`{c}` string" for c in EDGE_COLUMNS))
    found = graph.unify(edges, edges)
    wanted = edges.filter("x_name <> '' and y_name <> ''").distinct()
    assert found.columns == wanted.columns and found.count() == 9
    assert found.exceptAll(wanted).count() == wanted.exceptAll(found).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert [line for line in plan.split("\n") if "hashpartitioning" in line and "y_name" in line] == []
