"""From payload files to a graph, a summary and questions, without a model."""

import json

import pytest

from retort import workflow


def option(i, solvent, y, ee):
    return {"id": f"r{i}", "source_pages": [i], "reaction_type": "coupling", "substrates": [{"name": "benzaldehyde", "symbol": "1a", "scaffold": "aldehyde"}], "products": [{"name": "", "symbol": "3a"}], "catalysts": [{"name": "Pd(OAc)2", "amount": "5 mol%"}], "conditions": {"solvent": solvent, "solvent_amount": "2 mL"}, "targets": {"yield": y, "ee": ee, "er": "95:5"}}


@pytest.fixture
def folders(tmp_path):
    text, image = tmp_path / "text", tmp_path / "image"
    text.mkdir()
    image.mkdir()
    reactions = [option(1, "THF", "90%", None), option(2, "DMF", "80%", "70%"), option(3, "DMSO", "10%", "10%"), {**option(4, "THF", "90%", None), "conditions": {"solvent": "PhMe"}}]
    (text / "P1.json").write_text(json.dumps({"paper_key": "P1", "reactions": reactions}))
    record = {"pdf_name": "P1", "image_name": "fig1.png", "status": "ok", "reactions": [{"reaction_id": "i1", "reactants": [{"smiles": "O=Cc1ccccc1"}], "products": [{"symbol": "3a"}], "conditions": [{"role": "reagent", "refined_role": "ligand", "text": "BINAP (6 mol%)"}, {"role": "solvent", "text": "THF"}, {"role": "yield", "text": "91%"}]}]}
    (image / "P1_fig1.json").write_text(json.dumps(record))
    (image / "bad.json").write_text(json.dumps({"pdf_name": "P1", "status": "error", "reactions": [{"reaction_id": "x"}]}))
    return str(text), str(image)


def test_whole_run(spark, folders):
    loaded = workflow.load(spark, *folders)
    merged, conversions = workflow.merge(loaded)
    assert {r.conversion: r.n for r in conversions.collect()} == {"converted_exact": 2, "existing_ee": 2, "no_er": 1}
    unique = workflow.dedupe_reactions(merged)
    rows = {r.original_id: r.reaction for r in unique.filter("source_modality = 'text'").collect()}
    assert set(rows) == {"r1", "r2", "r3"}, "the fourth differs in conditions only"
    assert rows["r1"].id == "NonGP-Entry1" and rows["r1"].source_pages == [1, 4] and rows["r1"].targets.ee == "90%"
    registry = spark.createDataFrame([("P1", "3A", "stilbene", 0)], "source_paper string, symbol string, name string, pos int")
    named, statuses = workflow.backfill(unique, registry)
    assert workflow.unchanged(unique, named)
    assert {r.status: r.n for r in statuses.collect()}["resolved"] == 4
    edges, aligned = workflow.build_graph(named)
    assert {(r.relationship, r.image_id) for r in aligned.collect()} == {("NAME_RESOLVED_BY", "image:P1:NonGP-Entry1:products:0")}
    summary = {(r.paper, r.location): r for r in workflow.summarize(edges).collect()}
    one = summary["P1", "NonGP-Entry1; PDF pages: 1, 4"]
    assert (one["product"], one.solvent, one.catalyst, one.ee) == ("stilbene", "THF (2 mL)", "Pd(OAc)2 (5 mol%)", "90%")
    assert summary["P1", "NonGP-Entry1"].catalyst == "BINAP (6 mol%)", "image ligands are filed under catalysts"
    packages = workflow.question_packages(named)
    found, review = packages["Q1", "text", "combined_ee_yield"]
    q = found.first()
    assert (q.id, q.n_options, q.best, len(q.gold)) == ("Q1_COMBINED_TEXT_0001", 3, 90.0, 1)
    assert review.count() == 0
    assert packages["Q1", "text", "yield_only"][1].first().reason == "insufficient_objective_options"
    assert packages["Q1", "image", "combined_ee_yield"][0].count() == 0
