"""Payloads, pages, logs and writers on small files."""

import json

from pyspark.sql import functions as F

from retort import schemas
from retort.operators import filters
from retort.sources import payloads, sinks

PAPER = {
    "source": "papers/Alpha_si.pdf",
    "reactions": [
        {"id": "r1", "source_pages": [3, 1], "reaction_type": "coupling", "substrates": [{"name": "benzaldehyde", "symbol": "1a", "scaffold": "benzaldehyde"}], "products": [{"name": "stilbene", "step": 1}], "catalysts": [{"name": "Pd(OAc)2", "amount": "5 mol%"}], "conditions": {"solvent": "THF", "volume": "2 mL", "temperature": "25 °C"}, "targets": {"yield": "92%", "ee": None}, "er": "95:5"},
        {"id": "r2", "substrates": ["toluene"], "products": [{"name": "Product"}], "conditions": {"time": [{"step": 2, "value": "3 h"}, {"step": "Step 1", "value": "1 h"}]}, "yield": "40%", "step_count": 2},
        "not a reaction",
        {"substrates": [], "products": [{"name": "x"}]},
    ],
}


def write(tmp_path, name, value):
    (tmp_path / name).write_text(value if isinstance(value, str) else json.dumps(value), encoding="utf-8")


def read(spark, tmp_path):
    write(tmp_path, "a.json", PAPER)
    write(tmp_path, "b.json", "[1, 2]")
    write(tmp_path, "c.json", "{broken")
    return payloads.reactions_of(payloads.read_payloads(spark, str(tmp_path)))


def test_reactions_have_one_shape(spark, tmp_path):
    rows = read(spark, tmp_path).orderBy("reaction_pos").collect()
    assert [r.reaction.id for r in rows] == ["r1", "r2", "text_reaction_4"]
    first, second, _ = (r.reaction for r in rows)
    assert rows[0].source_paper == "Alpha"
    assert first.source_pages == [1, 3]
    assert first.targets.asDict() == {"yield": "92%", "ee": None, "er": "95:5", "dr": None}
    assert {k: [(v.step, v.value) for v in vs] for k, vs in first.conditions.items()} == {"solvent": [(None, "THF")], "volume": [(None, "2 mL")], "temperature": [(None, "25 °C")]}
    assert [(v.step, v.value) for v in second.conditions["time"]] == [(2, "3 h"), (1, "1 h")]
    assert second.substrates[0].name == "toluene" and second.targets["yield"] == "40%"


def test_compounds_and_filter(spark, tmp_path):
    rows = read(spark, tmp_path)
    found = payloads.explode_compounds(rows).select("id", "field", "item_pos", "compound.name").collect()
    assert ("r1", "catalysts", 0, "Pd(OAc)2") in {tuple(r) for r in found}
    labelled = filters.label_reactions(rows)
    assert {r["reaction.id"]: r.reason for r in labelled.select(F.col("reaction.id").alias("reaction.id"), "reason").collect()} == {"r1": None, "r2": "invalid_name", "text_reaction_4": "empty_side"}
    assert filters.filter_stats(labelled).first().asDict() == {"input": 3, "basic_failed": 2, "target_failed": 0, "retained": 1}


def test_logs_and_tables(spark, tmp_path):
    write(tmp_path, "log.jsonl", '{"operation": "a", "elapsed_seconds": 1.5}\nnot json\n{"operation": "b"}\n')
    assert [r.operation for r in payloads.read_events(spark, str(tmp_path / "log.jsonl"), schemas.TIMING_EVENT).filter("operation is not null").orderBy("operation").collect()] == ["a", "b"]
    write(tmp_path, "map.csv", "﻿paper,si_pdf,pdf\nk,s.pdf,\n")
    assert payloads.read_paper_map(spark, str(tmp_path / "map.csv")).first().asDict() == {"paper_key": "k", "si_file": "s.pdf", "pdf_file": None}
    assert spark.range(1).select(payloads.gpu_samples(F.lit("0, 100, 200")).alias("g")).first().g.asDict() == {"gpu_index": 0, "memory_used": 100, "memory_total": 200, "utilization": None}


def test_pages(spark):
    rows = spark.createDataFrame([("k", "--- Page 1 ---\nA\n--- Page 3 ---\n \n--- Page 4 ---\nB")], "paper string, text string")
    assert [tuple(r) for r in payloads.split_pages(rows).orderBy("page_num").collect()] == [("k", 1, "A"), ("k", 4, "B")]


def test_bundle_manifest_does_not_depend_on_order(spark, tmp_path):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "i int, s string")
    one = sinks.write_bundle({"q": a}, str(tmp_path / "one")).collect()
    two = sinks.write_bundle({"q": a.orderBy(F.col("i").desc()).repartition(3)}, str(tmp_path / "two")).collect()
    assert one == two and one[0].rows == 2
