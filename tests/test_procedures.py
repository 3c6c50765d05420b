"""General procedures and invariants on small cases."""

import json

from pyspark.sql import functions as F

from retort import schemas
from retort.operators import procedures, resolve, validation


def test_titles(spark):
    rows = spark.createDataFrame([(0, "General Procedure A: coupling"), (1, "2.1 general experimental procedure for B"), (2, "Materials")], "i int, s string").orderBy("i")
    assert [r[0] for r in rows.select(procedures.gp_key(F.col("s"))).collect()] == ["A", "B", None]
    assert [r[0] for r in rows.select(procedures.section_title(F.col("s"))).collect()][1] == "general experimental procedure for b"
    assert rows.limit(1).select(procedures.gp_aliases(F.lit("A"))).first()[0][0] == "general procedure a"


def test_references(spark):
    rows = spark.createDataFrame([(0, "prepared following general procedure A"), (1, "the mixture was stirred"), (2, "GP-B gave 3a")], "i int, s string").orderBy("i")
    assert [r[0] for r in rows.select(procedures.refers_to_gp(F.col("s"))).collect()] == [True, False, True]


def test_definitions_and_references(spark):
    text = "According to\n--- Page 4 ---\nGeneral procedure A: was heated. General procedure B: a flask was charged with salt and kept at that for as long as it took, three days or more, which nobody had foreseen. General procedure C: using 3 g, stirred"
    rows = spark.createDataFrame([(c, text.index(f"General procedure {c}")) for c in "ABC"], "c string, at int").withColumn("text", F.lit(text))
    got = rows.select("c", procedures.defines_gp(F.col("text"), F.col("at"), F.col("at") + 20).alias("d")).collect()
    assert {r.c: r.d for r in got} == {"A": False, "B": True, "C": False}
    odd = spark.createDataFrame([("",), (None,), ("General procedures",), ("x" * 5000,)], "title string")
    assert [r[0] for r in odd.select(procedures.title_key(F.col("title"))).collect()] == [None] * 4


def test_templates(spark):
    templates = spark.createDataFrame([("A", 0), ("B", 1)], "gp_key string, pos int")
    reactions = spark.createDataFrame([(1, "b", "x"), (2, None, "General Procedure A-Entry1"), (3, None, "none")], "row_id int, gp_source string, id string")
    assert {r.row_id: r.gp_key for r in procedures.template_for(reactions, templates).collect()} == {1: "B", 2: "A", 3: None}
    log = procedures.gp_log(templates, spark.createDataFrame([("A", True), ("C", False)], "gp_key string, valid boolean"), spark.createDataFrame([("A",)], "gp_key string"))
    assert {r.gp_key: (r.status, r.recorded) for r in log.collect()} == {"A": ("valid", True), "B": ("error", False), "C": ("invalid", False)}


def test_sections_of_pages(spark):
    sections = spark.createDataFrame([("k", "S1", 1, 2), ("k", "S2", 3, 3)], "paper string, title string, start_page int, end_page int")
    pages = spark.createDataFrame([("k", i, f"p{i}") for i in (1, 2, 3)] + [("z", 1, "other")], "paper string, page_num int, text string")
    got = procedures.section_chunks(sections.filter("title = 'S1'"), sections, pages, ["paper"]).first()
    assert (got.page_nums, got.preview) == ([1, 2], "p1\np2")


def test_aliases_in_blocks(spark):
    rows = spark.createDataFrame([("xx abc yy",), ("bcd",), ("q",)], "t string")
    aliases = spark.createDataFrame([("abc",), ("bc",), ("q",), ("zz",)], "a string")
    one = sorted(map(tuple, resolve.contains_join(rows, aliases, "t", "a").collect()))
    assert one == sorted(map(tuple, resolve.contains_join(rows, aliases, "t", "a", block_chars=70).collect())) and len(one) == 4


def test_retry_messages(spark):
    bodies = [{"id": "a", "substrates": [{"name": "x"}], "products": [{"name": "Product"}], "targets": {"yield": "9%"}}, {"id": "b", "substrates": [{}], "products": [{"name": "y"}]}]
    rows = spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(bodies)], "reaction_pos int, j string").withColumn("reaction", F.from_json("j", schemas.REACTION))
    assert {r.message: r.examples for r in validation.retry_messages(rows).collect()} == {"placeholder_product": "a", "unnamed_substrate": "b", "no_target": "b"}
    row = rows.select(validation.specific_products(F.col("reaction.products")), validation.hidden_symbols(F.col("reaction.products"))).collect()
    assert [tuple(r) for r in row] == [([], []), ([0], [])]


def test_accept_identities(spark):
    rows = [("ketone", "acetone", [], "named in text", [1], [1, 2], None), ("ketone", "", [], "", [1], [1], "empty_name"), ("ketone", "product", [], "x", [1], [1], "generic_name"), ("ketone", "3a", [], "x", [1], [1], "symbol_only"), ("k", "p", ["P"], "x", [1], [1], "is_a_product"), ("k", "p", [], "not sure", [1], [1], "uncertain_evidence"), ("k", "p", [], "x", [], [1], "no_pages"), ("k", "p", [], "x", [3], [1], "foreign_pages")]
    got = validation.accept_identities(spark.createDataFrame(rows, "reported string, proposed string, products array<string>, evidence string, source_pages array<int>, allowed_pages array<int>, expected string"))
    assert all(r.reject == r.expected for r in got.collect())


def test_resolution_violations(spark):
    rows = spark.createDataFrame([("P", "3a", "3a", "", "products"), ("P", "4b", "4b", "", "products"), ("P", "5c", "toluene", "", "products"), ("P", "6d", "6d", "please check", "products"), ("P", "7e", "7e", "", "temperature")], "paper string, symbol string, name string, text string, field string")
    bad = spark.createDataFrame([("P", "4b")], "paper string, symbol string")
    got = {r.symbol: r.violation for r in validation.resolution_violations(rows, bad, ["paper"]).collect()}
    assert got == {"4b": "ambiguous_symbol", "5c": "had_a_name", "6d": "uncertain_text", "7e": "not_a_compound"}


def test_backfill_leaves_outcomes(spark):
    before = spark.createDataFrame([(1, "90%"), (2, "80%")], "i int, y string")
    assert validation.changed_outcomes(before, before.orderBy("y"), "i", "y").count() == 0
    assert validation.changed_outcomes(before, before.filter("i = 1"), "i", "y").collect()[0].i == 2
