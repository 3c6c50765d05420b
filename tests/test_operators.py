"""Canonical forms, duplicates, identity, questions, sections and reports on small cases."""

import json

import duckdb
from pyspark.sql import functions as F

from retort import registry, schemas
from retort.functions import metrics as m
from retort.operators import canon, dedupe, filters, graph, questions, reports, resolve, sections


def reactions(spark, *bodies):
    rows = spark.createDataFrame([("P", i, json.dumps(b)) for i, b in enumerate(bodies)], "source_paper string, reaction_pos int, j string")
    return rows.select("source_paper", "reaction_pos", F.from_json("j", schemas.REACTION).alias("reaction"))


def test_targets(spark):
    rows = spark.createDataFrame([(0, "null", None, "95:5", None, "90%"), (1, "", "", None, "", None)], "i int, y string, ee string, er string, dr string, top string")
    target = F.struct(F.col("y").alias("yield"), "ee", "er", "dr")
    top = F.struct(F.col("top").alias("yield"), F.lit(None).cast("string").alias("ee"), F.lit(None).cast("string").alias("er"), F.lit(None).cast("string").alias("dr"))
    lifted = rows.select("i", canon.lift_targets(target, top).alias("t"))
    out, status = canon.derive_ee(F.col("t"))
    got = [tuple(r) for r in lifted.select("i", out["yield"], out["ee"], status).orderBy("i").collect()]
    assert got == [(0, "90%", "90%", "converted_exact"), (1, None, None, None)]


def test_steps(spark):
    rows = reactions(spark, {"step_count": 1, "substrates": [{"name": "a", "step": 3}], "intermediates": [{"name": "I", "produced_in_step": 2, "consumed_in_step": 1}]}, {"conditions": {"time": [{"step": 2, "value": "1 h"}]}, "intermediates": [{"name": "I", "produced_in_step": 1, "consumed_in_step": 2}, {"name": "i", "produced_in_step": 1, "consumed_in_step": 2}]})
    r = F.col("reaction")
    count = canon.step_count(r, schemas.ROLES)
    assert [tuple(x) for x in rows.select(count, canon.step_error(r, count)).collect()] == [(3, "produced_not_before_consumed"), (2, "repeated_intermediate")]


def test_condition_shapes(spark):
    rows = reactions(spark, {"conditions": {"volume": [{"value": "2 mL"}], "concentration": [{"value": ""}], "time": [{"step": 1, "value": "1 h"}, {"step": 1, "value": "2 h"}]}})
    c = F.col("reaction.conditions")
    got = rows.select(canon.condition_amounts(c).alias("a"), canon.single_step(c).alias("s")).first()
    assert sorted(got.a) == ["solvent_amount", "time"] and got.s["time"][0].value == "1 h; 2 h" and got.s["time"][0].step is None


def test_image_roles(spark):
    rows = spark.createDataFrame([("r", json.dumps([{"role": "reagent", "refined_role": "ligand", "text": "L"}, {"role": "light_source", "text": "LED"}, {"role": "yield", "text": "9%"}, {"refined_role": "unknown", "role": "base", "text": "K2CO3"}, {"text": "x"}]))], "id string, j string")
    rows = rows.select("id", F.from_json("j", "array<struct<role:string,refined_role:string,original_role:string,text:string,label:string,iupac_name:string,smiles:string>>").alias("conditions"))
    got = [(r.target, r.value) for r in canon.route_conditions(rows, ["id"]).orderBy("item_pos").collect()]
    assert got == [("catalysts", "L"), ("conditions.light", "LED"), ("targets.yield", "9%"), ("additives", "K2CO3"), ("reagents", "x")]


def test_nested_paths(spark):
    rows = spark.createDataFrame([("k", '{"a": [{"hit": 1}, {"b": {"hit": {"hit": 2}}}]}')], "key string, j string").select("key", F.parse_json("j").alias("v"))
    assert {r.path for r in canon.nested_paths(rows, "key", "v", "hit").collect()} == {"$.a[0].hit", "$.a[1].b.hit", "$.a[1].b.hit.hit"}


def test_merge_same_compounds_and_inheritance(spark):
    rows = spark.createDataFrame([("g", "L1", 1, "5 mg", 0), ("g", "L1", 1, "6 mg", 1), ("g", "L1", 1, "5 mg", 2), ("g", "L1", 2, None, 3)], "g string, name string, step int, amount string, pos int")
    got = {(r.name, r.step): (r.amount, r.pos) for r in canon.merge_same_compounds(rows, ["g"], "name", "step", "amount", "pos").collect()}
    assert got == {("L1", 1): ("5 mg; 6 mg", 0), ("L1", 2): ("", 3)}
    score = spark.range(1).select(canon.inheritance({"solvent": F.lit(True), "time": F.lit(False), "base": F.lit(True)}).alias("s")).first().s
    assert (score.reasons, score.score) == (["solvent", "base"], 2)


def test_signature_ignores_conditions(spark):
    rows = reactions(spark, {"substrates": [{"name": "a"}], "source_pages": [2], "conditions": {"time": [{"value": "1 h"}]}}, {"substrates": [{"name": "a"}], "source_pages": [1, 2]}, {"substrates": [{"name": "b"}]})
    r = F.col("reaction")
    flat = rows.select("reaction_pos", dedupe.signature(r["substrates"], r["products"], r["intermediates"], r["step_count"], r["targets"]).alias("sig"), F.coalesce(r["source_pages"], F.array()).alias("pages"))
    got = [(x.reaction_pos, x.pages) for x in dedupe.dedupe_union(flat, ["sig"], ["reaction_pos"], ["reaction_pos"], "pages").orderBy("reaction_pos").collect()]
    assert got == [(0, [1, 2]), (2, [])]


def test_unique_suffixes_avoid_literal_keys(spark):
    rows = spark.createDataFrame([("p", i, k) for i, k in enumerate(["x", "x", "x_2", "x", "y"])], "p string, pos int, k string")
    assert [r.unique_key for r in dedupe.unique_suffixes(rows, ["p"], ["pos"], "k").orderBy("pos").collect()] == ["x", "x_3", "x_2", "x_4", "y"]


def test_registry_alignment(spark):
    comp = lambda **k: k
    bodies = [comp(name="", symbol="1a"), comp(name="ligand L1", label=None), comp(name="Toluene", symbol="2b"), comp(name="benzene", symbol="2b"), comp(name="unknown thing"), comp(name="3", symbol="3k")]
    rows = spark.createDataFrame([("P", "products", i, json.dumps(b)) for i, b in enumerate(bodies)], "source_paper string, field string, item_pos int, j string").withColumn("compound", F.from_json("j", schemas.COMPOUND)).drop("j")
    registry = spark.createDataFrame([("P", "1A", "anisole", 0), ("P", "L1", "BINAP", 1), ("P", "2b", "toluene", 2), ("P", "3k", "phenol", 3), ("Q", "unknown thing", "z", 4)], "source_paper string, symbol string, name string, pos int")
    got = [(r.status, r.name) for r in resolve.align_registry(rows, registry).orderBy("item_pos").collect()]
    assert got == [("resolved", "anisole"), ("resolved", "BINAP"), ("verified", "Toluene"), ("conflict", "benzene"), ("none", "unknown thing"), ("resolved", "phenol")]


def test_as_of_takes_rows_of_the_same_time_and_keeps_those_before_any(spark):
    left = spark.createDataFrame([("k", 1, 10), ("k", 5, 11), ("k", 7, 12), ("z", 1, 13)], "key string, at int, id int")
    right = spark.createDataFrame([("k", 5, "a"), ("k", 6, "b")], "key string, at int, v string")
    got = {r.id: r.v for r in resolve.as_of(left, right, ["key"], "at", "id", "v").collect()}
    assert got == {10: None, 11: "a", 12: "b", 13: None}


def test_range_join_has_each_pair_once(spark):
    points = spark.createDataFrame([(i,) for i in range(20)], "p int")
    spans = spark.createDataFrame([(0, 3, 11), (1, 5, 5)], "s int, lo int, hi int")
    got = sorted((r.s, r.p) for r in resolve.range_join(points, spans, "p", "lo", "hi", 4).collect())
    assert got == [(0, p) for p in range(3, 12)] + [(1, 5)]


def test_range_join_deals_points_of_full_bins_into_blocks(spark, monkeypatch):
    points = spark.createDataFrame([(i, i % 7) for i in range(300)], "i int, p int")
    spans = spark.createDataFrame([(0, 0, 3), (1, 2, 2), (2, 6, 9), (3, 8, 9)], "s int, lo int, hi int")
    expected = sorted((i, s) for i in range(300) for s, lo, hi in ((0, 0, 3), (1, 2, 2), (2, 6, 9), (3, 8, 9)) if lo <= i % 7 <= hi)
    for pairs in (1, 100, 10**6):
        monkeypatch.setattr(resolve, "BLOCK_PAIRS", pairs)
        met = resolve.range_join(points, spans, "p", "lo", "hi", 5)
        assert sorted((r.i, r.s) for r in met.collect()) == expected and met.columns == ["i", "p", "s", "lo", "hi"]
        if pairs == 1:  # two bins, and yet rows in more tasks than bins
            assert met.select(F.spark_partition_id().alias("t")).distinct().count() > 2
    assert resolve.range_join(points.limit(0), spans, "p", "lo", "hi", 5).count() == 0


def test_candidates_go_out_where_they_meet(spark):
    rows = [(1, "p", "a", "x"), (2, "p", "b", "x"), (3, "p", "", "y"), (4, "p", None, "x"), (5, "q", "a", "x"), (6, "p", "a", "x")]
    others = [(10, "p", "a", "x"), (11, "p", "a", "y"), (12, "p", "b", "x"), (13, "p", None, ""), (14, "q", "c", "x")]
    schema = "i int, s string, k string, l string"

    def found(rows, others):
        df = resolve.candidates(spark.createDataFrame(rows, schema), spark.createDataFrame([(6,)], "i int"), spark.createDataFrame(others, schema).withColumnRenamed("i", "o"), ["s"], ["k", "l"], "i", "o")
        return df, sorted((r.i, r.o, r.method) for r in df.collect())

    def expected(rows, others):
        best = {}
        for i, s, k, x in rows:
            for o, t_, m_, y in others:
                rank = 0 if k and k == m_ else 1 if x and x == y else None
                if i != 6 and s == t_ and rank is not None:
                    best[i, o] = min(rank, best.get((i, o), 1))
        return sorted((i, o, "kl"[r]) for (i, o), r in best.items())

    df, got = found(rows, others)
    assert got == expected(rows, others) and "Aggregate" not in df._jdf.queryExecution().optimizedPlan().toString()
    rows, others = [*rows, (2, "p", "a", "z"), (2, "p", "b", "x")], [*others, (11, "p", "b", "x")]
    assert found(rows, others)[1] == expected(rows, others)


def test_pairs_of_parts_and_blocks_are_all_pairs(spark, monkeypatch):
    rows = [(i, "p", "abc"[i % 3], "xy"[i % 2]) for i in range(30)] + [(None, "p", "a", "x"), (1, "p", "a", "y")]
    others = [(100 + i, "p", "abd"[i % 3], "xz"[i % 2]) for i in range(20)] + [(None, "p", "d", "x")]
    best = {}
    for i, _, k, x in rows:
        for o, _, m, y in others:
            if k == m or x == y:
                best[i, o] = min(0 if k == m else 1, best.get((i, o), 1))
    schema = "i int, s string, k string, l string"
    a, b = spark.createDataFrame(rows, schema), spark.createDataFrame(others, schema).withColumnRenamed("i", "o")
    for pairs, least, ids in ((10**6, 1000, 500), (5, 2, 3)):
        for name, value in (("PART_PAIRS", pairs), ("PART_ROWS", least), ("BLOCK_IDS", ids)):
            monkeypatch.setattr(resolve, name, value)
        got = [(r.i, r.o, r.method) for r in resolve.first_key_pairs(a, b, ["s"], ["k", "l"], "i", "o").collect()]
        assert sorted(got, key=str) == sorted(((i, o, "kl"[r]) for (i, o), r in best.items()), key=str)


def test_pairs_of_systematic_names_are_not_gathered(spark):
    schema = "entity_id string, source_paper string, field string, name string, iupac string, smiles string, symbol string, token string"
    side = lambda x: spark.createDataFrame([(f"{x}{i}", "p", "products", f"n{i % 2}", f"n{i % 2}" if i < 4 else "", "", f"{x}{i}", "") for i in range(6)], schema)
    found = graph.align(side("t"), side("i"))
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert not [line for line in plan if "Aggregate [" in line and "image_id" in line]
    got = sorted((r.text_id, r.image_id) for r in found.filter("relationship = 'SAME_AS'").collect())
    assert got == sorted((f"t{i}", f"i{j}") for i in range(4) for j in range(4) if i % 2 == j % 2)


def test_bands_of_large_balances_are_written_as_in_sql(spark, tmp_path):
    c = duckdb.connect()
    c.execute("CREATE TABLE customer AS SELECT i AS c_custkey, 1 AS c_nationkey, b AS c_acctbal FROM (VALUES (1, 2e9), (2, -50.0), (3, 123456789012.5), (4, NULL), (5, 0.0), (5, 0.0)) t(i, b)")
    c.execute("CREATE TABLE supplier AS SELECT c_custkey + 10 AS s_suppkey, c_nationkey AS s_nationkey, c_acctbal + 20 AS s_acctbal FROM customer")
    for t_ in ("customer", "supplier"):
        c.execute(f"COPY (SELECT * REPLACE ({t_[0]}_acctbal::DOUBLE AS {t_[0]}_acctbal) FROM {t_}) TO '{tmp_path}/{t_}.parquet'")
        c.execute(f"CREATE VIEW {t_}_ AS SELECT * FROM '{tmp_path}/{t_}.parquet'")
    sql = registry.ORACLE_SQL["entity_alignment"].replace("customer JOIN supplier", "customer_ JOIN supplier_")
    expected = sorted(c.execute(sql).fetchall())
    got = registry.QUERIES["entity_alignment"](spark, str(tmp_path)).select("left_id", "right_id", "nation", "key").collect()
    assert sorted(map(tuple, got)) == expected and "20000000.0" in {r[3] for r in expected}


def test_bands_of_odd_balances_are_written_as_in_sql(spark, tmp_path):
    c = duckdb.connect()
    odd = ["0", "-0.0", "5", "-5", "1e17", "1e18", "-3e18", "1.2345678901234567e19", "1e300", "nan", "inf", "-inf"]
    for name, p, id_ in (("customer", "c", "c_custkey"), ("supplier", "s", "s_suppkey")):
        values = ", ".join(f"({i}, 1, '{b}'::DOUBLE)" for i, b in enumerate(odd)) + f", ({len(odd)}, 1, NULL), ({len(odd)}, NULL, 5)"
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM (VALUES {values}) t({id_}, {p}_nationkey, {p}_acctbal)")
        c.execute(f"COPY {name} TO '{tmp_path}/{name}.parquet'")
    expected = c.execute(registry.ORACLE_SQL["entity_alignment"]).fetchall()
    got = registry.QUERIES["entity_alignment"](spark, str(tmp_path)).select("left_id", "right_id", "nation", "key").collect()
    assert sorted(map(tuple, got)) == sorted(expected) and {"-0.0", "1e+16", "nan", "-inf"} <= {r[3] for r in expected}


def option(condition, ee, yield_, **extra):
    return {"substrates": [{"name": "S"}], "products": [{"name": "T"}], "reaction_type": "coupling", "conditions": {"solvent": [{"value": condition}]}, "targets": {"ee": ee, "yield": yield_}, **extra}


def test_condition_questions(spark):
    rows = reactions(spark, option("THF", "90%", "80%"), option("DMF", "80%", "90%"), option("DMSO", "50%", "50%"), option("PhMe", None, "99%"), option("PhMe", "10%", "10%"), option("PhMe", "11%", "10%"), option("MeOH", "1%", "1%", reaction_type="n/a"), option("MeOH", "1%", "1%", products=[]))
    found, review = questions.condition_questions(rows)
    q = found.first()
    assert (q.n_options, q.best, q.gold, q.ranked, q.top3) == (3, 85.0, ["0", "1"], ["0", "1", "2"], True)
    assert sorted((r.reason, r.n) for r in review.collect()) == [("duplicate_public_conditions_conflicting_results", 2), ("missing_product", 1), ("unknown_reaction_type", 1)]


def test_questions_and_review_cover_all_groups(spark):
    rows = reactions(spark, option("A", "90%", "80%"), option("B", None, "80%", substrates=[{"name": "U"}]), option("C", None, "70%", substrates=[{"name": "U"}]))
    found, review = questions.condition_questions(rows, m.YIELD_ONLY)
    assert [q.substrates for q in found.collect()] == [["U"]]
    assert [(r.substrates, r.reason) for r in review.collect()] == [(["S"], "insufficient_objective_options")]


def substrate(name, other="G", ee="90%", **extra):
    return {"substrates": [{"name": name, "scaffold": "aldehyde"}, {"name": other, "scaffold": "glycine"}], "reaction_type": "x", "conditions": {"solvent": [{"value": "THF (dry)"}]}, "targets": {"ee": ee, "yield": "50%"}, **extra}


def test_substrate_questions(spark):
    rows = reactions(spark, substrate("a"), substrate("b", ee="70%", conditions={"solvent": [{"value": "thf dry"}]}))
    found, review = questions.substrate_questions(rows)
    q = found.first()
    assert (q.variable, q.n_options, q.gold) == ("aldehyde", 2, ["0"])
    # the glycine is the same in both while the aldehydes differ
    assert [(r.variable, r.reason) for r in review.collect()] == [("glycine", "fixed_substrate_mismatch")]
    double = reactions(spark, {**substrate("a"), "substrates": [{"name": "a", "scaffold": "s"}, {"name": "b", "scaffold": "s"}]})
    assert [r.reason for r in questions.substrate_questions(double)[1].collect()] == ["variable_scaffold_not_unique"]


def test_string_order_breaks_ties(spark):
    rows = spark.createDataFrame([("g", 2, 5.0), ("g", 10, 5.0), ("g", 1, 4.0)], "g string, i int, v double")
    got = [r.i for r in questions.rank_options(rows, ["g"], F.lit(True), F.col("v"), "i").orderBy("rank").collect()]
    assert got == [10, 2, 1]


def test_sections(spark):
    pages = spark.createDataFrame([("k", i, c) for i, c in enumerate([100, 7000, 2000, 9000, 10, 10])], "k string, page int, c int")
    got = [(r.chunk, r.orders, r.chars) for r in sections.greedy_chunks(pages, ["k"], "page", F.col("c")).orderBy("chunk").collect()]
    assert got == [(0, [0, 1], 7100), (1, [2], 2000), (2, [3], 9000), (3, [4, 5], 20)]
    titles = spark.createDataFrame([("k", "Alpha", 1), ("k", "Beta", 3), ("k", "Gamma", 9)], "k string, title string, printed_page int")
    texts = spark.createDataFrame([("k", 3, "ALPHA part"), ("k", 5, "Beta"), ("k", 6, "beta again"), ("k", 10, "gamma")], "k string, page_num int, text string")
    assert [tuple(r) for r in sections.toc_offset(titles, texts, "k").collect()] == [("k", 2)]
    spans = sections.spans_of(spark.createDataFrame([("d", "intro GP A: text GP B: more")], "d string, text string"), ["d"], r"GP \w:")
    assert [(r.pos, r.title, r.end) for r in spans.orderBy("pos").collect()] == [(6, "GP A:", 17), (17, "GP B:", 27)]


def test_filters(spark):
    rows = spark.createDataFrame([("d", "MgSO was\nEt O here and Na CO"), ("e", "nothing")], "d string, text string")
    got = sorted((r.line_no, r.pattern, r.match) for r in filters.broken_formulas(rows, "d").collect())
    assert got == [(1, "magnesium_sulfate_missing_subscript", "MgSO"), (2, "alkali_carbonate_gap", "Na CO"), (2, "ether_gap", "Et O")]
    assert [r.modality for r in filters.unknown_modalities(spark.createDataFrame([("text",), ("sound",)], "m string"), "m").collect()] == ["sound"]


def test_reports(spark):
    events = spark.createDataFrame([("m", "s", "p", 10, 5, None), ("m", "t", "p", 1, 1, 9)], "model string, stage string, pdf_name string, prompt_tokens long, completion_tokens long, total_tokens long")
    got = {(r.by, r.value): (r.calls, r.total_tokens) for r in reports.usage(events).collect()}
    assert got == {("total", None): (2, 24), ("model", "m"): (2, 24), ("stage", "s"): (1, 15), ("stage", "t"): (1, 9), ("pdf_name", "p"): (2, 24)}
    assert reports.overhead(spark.createDataFrame([("i", "wall", 5.0), ("i", "leaf", 3.0)], "image string, event_kind string, elapsed_seconds double"), ["image"]).first().overhead == 2.0


def test_empty_tables(spark):
    none = reactions(spark, {"id": "x"}).filter("false")
    assert questions.condition_questions(none)[0].count() == questions.substrate_questions(none)[1].count() == 0
    assert filters.filter_stats(filters.label_reactions(none)).first().input == 0
