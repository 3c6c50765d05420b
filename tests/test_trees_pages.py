"""Nested values folded and written back, and pages of words, against plain recursion and layouts by hand."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from retort.operators import pagetext, trees
from retort.providers import Dictionary


def values(r, depth):
    kind = r.randrange(6 if depth else 3)
    if kind == 0:
        return r.choice(["2 Hours", "2 h", " (2) h ", "", "  ", "Pd2(dba)3", "Pd2(DBA)3,", 'a"b', "x\\y", "é"])
    if kind == 1:
        return r.choice([None, True, 3, 0, "5 mol %", "5 mol%"])
    if kind == 2:
        return r.choice([[], {}, "THF; dry", "THF dry"])
    if kind == 3:
        return [values(r, depth - 1) for _ in range(r.randrange(4))]
    return {r.choice(["name", "amount", "a.b", "a", "b", 'q"', "smiles", "steps"]): values(r, depth - 1) for _ in range(r.randrange(4))}


def text_key(text, mode):
    text = text.strip().lower()
    for pattern, to in ((r"\bhours?\b|\bhrs?\b", "h"), (r"\bmol\s*%\b", "mol%"), (r"[,;:]" if mode == "name" else r"[()\[\]{},;:]", " ")):
        text = re.sub(pattern, to, text)
    return " ".join(text.split())


def canonical(v, mode="condition"):
    if isinstance(v, str):
        return text_key(v, mode) or None
    if isinstance(v, list):
        return sorted((x for x in (canonical(i, mode) for i in v) if x is not None), key=dumped) or None
    if isinstance(v, dict):
        out = {k: canonical(x, "name" if k == "name" else "condition") for k, x in v.items()}
        return {k: x for k, x in out.items() if x is not None} or None
    return v


def dumped(v):
    return json.dumps(v, sort_keys=True, ensure_ascii=False, separators=(",", ":"))


def variants(spark, items):
    rows = spark.createDataFrame(list(enumerate(map(json.dumps, items))), "id long, j string")
    return rows.select("id", F.parse_json("j").alias("v"))


def test_canonical_values_by_recursion(spark):
    r = random.Random(1)
    items = [{"x": values(r, 4)} for _ in range(150)] + [values(r, 3) for _ in range(50)]
    got = {x.id: x.canonical for x in trees.canonical_values(variants(spark, items), "id", "v").collect()}
    assert got == {i: dumped(canonical(v)) if canonical(v) is not None else "{}" for i, v in enumerate(items)}


@pytest.mark.parametrize(
    "left, right, same",
    [
        ({"other_components": [{"name": "SOCl2", "amount": "711 μL 9.75 mmol, 3.25 equiv."}]}, {"other_components": [{"name": "SOCl2", "amount": "711 μL, 9.75 mmol, 3.25 equiv."}]}, True),
        ({"conditions": {"light_source": "Kessil lamp at 50% power, 427 nm"}}, {"conditions": {"light_source": "Kessil lamp at 50% power (427 nm)"}}, True),
        ({"catalysts": [{"name": "Pd2(dba)3", "amount": "4.6 mg, 0.005 mmol, 5 mol%"}]}, {"catalysts": [{"name": "Pd2(dba)3", "amount": "4.6 mg, 5 mol%"}]}, False),
        ({"ligands": [{"name": "L1", "amount": "1 mg"}]}, {"ligands": [{"amount": ["2 mg"], "name": "L1"}]}, True),
        ({"catalysts": [{"name": "Pd2(dba)3"}]}, {"catalysts": [{"name": "Pd2dba3"}]}, False),
    ],
)
def test_conditions_that_group_together(spark, left, right, same):
    got = [x.canonical for x in trees.canonical_values(variants(spark, [left, right]), "id", "v", without=trees.LIGAND_AMOUNTS).collect()]
    assert (got[0] == got[1]) is same


def named(v, memo):
    if isinstance(v, list):
        return [named(x, memo) for x in v]
    if not isinstance(v, dict):
        return v
    out = {k: named(x, memo) for k, x in v.items()}
    if "smiles" in v:
        s = v["smiles"].strip() if isinstance(v["smiles"], str) else ""
        out["iupac_name"] = memo.get(s) if s else None
        out["iupac_lookup_status"] = "skipped" if not s else "error" if s not in memo else "resolved" if memo[s] is not None else "not_found"
    return out


def test_names_written_back_by_recursion(spark):
    r = random.Random(2)
    items = [values(r, 4) for _ in range(100)] + [{"smiles": {"smiles": [{"smiles": "x\\y"}]}, "iupac_name": {"old": 1}}, [], None, {"a": [{"smiles": " c "}, {"smiles": "C"}, {"smiles": "unknown"}]}]
    memo = {"c": "small", "C": "large", "x\\y": None, "2 h": "two"}
    table = spark.createDataFrame(list(memo.items()), "key string, answer string")
    found, counts, _ = trees.names_written_back(variants(spark, items), "id", "v", table)
    got = {x.id: json.loads(x.j) for x in found.select("id", F.to_json("v").alias("j")).collect()}
    assert got == {i: named(v, memo) for i, v in enumerate(items)}
    assert {c.status for c in counts.collect()} == {"resolved", "not_found", "skipped", "error"}


def test_a_provider_is_asked_once_for_each_structure(spark):
    items = [{"a": [{"smiles": "C"}, {"smiles": "N"}]}, {"smiles": "C"}, {"smiles": "O"}]
    memo = spark.createDataFrame([("O", "water")], "key string, answer string")
    found, counts, grown = trees.names_written_back(variants(spark, items), "id", "v", memo, Dictionary({"C": "methane"}))
    assert {x.status: x.n for x in counts.collect()} == {"resolved": 3, "not_found": 1}
    assert sorted((x.key, x.answer) for x in grown.collect() if x.answer) == [("C", "methane"), ("O", "water")]
    assert found.count() == 3


BOX = "page_num int, text string, x0 double, x1 double, top double, bottom double, page_width double, page_height double"


def page(number, lines, x=20.0, top=100.0):
    return [(number, w, x + 50 * k, x + 50 * k + 40, top + 15 * i + k % 2, top + 15 * i + 10, 600.0, 800.0) for i, line in enumerate(lines) for k, w in enumerate(line.split())]


def test_pages_of_one_and_two_columns(spark):
    left, right = [f"l{i} a b c d" for i in range(16)], [f"r{i} e f g h" for i in range(16)]
    across = "\n".join(f"{x} {y}" for x, y in zip(left, right, strict=True))
    words = page(1, left) + page(1, right, x=320.0)
    words += page(2, left[:3]) + page(2, right[:3], x=320.0)  # too few words
    words += page(3, left * 2)  # one side only
    words += page(4, left) + page(4, right, x=320.0) + page(4, ["head line"], top=10.0) + [(5, " ", 1.0, 2.0, 3.0, 4.0, 600.0, 800.0)]
    words = spark.createDataFrame(words, BOX)
    got = {r.page_num: (r.two_column, r.text) for r in pagetext.page_texts(words, ["page_num"]).collect()}
    columns = "\n".join(left) + "\n\n" + "\n".join(right)
    assert got == {1: (True, columns), 2: (False, "\n".join(across.split("\n")[:3])), 3: (False, "\n".join(left * 2)), 4: (True, columns)}
    single = {r.page_num: r.text for r in pagetext.page_texts(words, ["page_num"], "single").collect()}
    assert single[1] == across and single[4] == "head line\n" + across
    forced = {r.page_num: (r.two_column, r.text) for r in pagetext.page_texts(words, ["page_num"], "two_column").collect()}
    assert forced[3] == (True, "\n".join(left * 2)) and not forced[2][0]  # under 80 characters: read across


def test_words_of_pages_are_shuffled_once(spark):
    words = spark.createDataFrame([(1, "b", 30.0, 40.0, 71.0, 80.0, 600.0, 800.0), (1, "a", 10.0, 20.0, 73.0, 80.0, 600.0, 800.0), (1, "c", 5.0, 9.0, 77.0, 90.0, 600.0, 800.0)], BOX)
    made = pagetext.page_texts(words, ["page_num"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Window" not in plan and "Join" not in plan
    assert [tuple(r) for r in made.collect()] == [(1, False, "a b\nc")]


def test_no_pages(spark):
    assert pagetext.page_texts(spark.createDataFrame([], BOX), ["page_num"]).count() == 0


def test_nodes_are_never_broadcast(spark):
    """Files of nodes are small beside the rows in memory, so that a table of a driver's memory looks as if it fitted."""
    levels = trees.unfold(variants(spark, [{"a": [{"smiles": "C"}]}, {"smiles": None}]), "id", "v")
    edits = spark.createDataFrame([(0, '$["a"][0]', 3, "smiles", '"O"'), (1, "$", 1, "n", "1")], "key long, parent string, depth int, field string, text string")
    made = trees.write_back(levels, edits)
    assert "Broadcast" not in made._jdf.queryExecution().executedPlan().toString()
    assert {r.key: r.text for r in made.collect()} == {0: '{"a":[{"smiles":"O"}]}', 1: '{"n":1,"smiles":null}'}


def test_canonical_values_in_their_rows_unless_deep(spark, monkeypatch):
    deep = {"name": " A "}
    for i in range(trees.NESTED - 1):
        deep = [deep, None] if i % 2 else {"x": deep, "b": ""}
    levels, unfolded = [], trees.unfold

    def unfold(rows, key, variant):
        levels.append(rows.count())
        return unfolded(rows, key, variant)

    monkeypatch.setattr(trees, "unfold", unfold)
    flat = [{"a": [[1, 2], ["B  c "]]}, None, [], {"name": "x (y)"}]
    for items, wanted in ((flat, []), ([*flat, deep, [deep], {"k": [deep]}], [2])):
        levels.clear()
        got = {x.id: x.canonical for x in trees.canonical_values(variants(spark, items), "id", "v").collect()}
        assert got == {i: dumped(canonical(v)) if canonical(v) is not None else "{}" for i, v in enumerate(items)}
        assert levels == wanted
