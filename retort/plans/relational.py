"""Joins, aggregates, graphs, questions, windows, sets and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from retort.functions import text as t
from retort.functions import vocab
from retort.operators import canon, dedupe, filters, graph, questions, reports, resolve, sections
from retort.plans.base import query
from retort.providers import memo_key



# --- duplicates -----------------------------------------------------------------------------------------------------
@query("signature_dedupe", "SELECT min(doc_id) AS doc_id, md5(text) AS signature, list_sort(list_distinct(list(source))) AS sources FROM documents GROUP BY text")
def signature_dedupe(spark, table):
    rows = table("documents").select("doc_id", F.md5("text").alias("signature"), F.array("source").alias("sources"))
    return dedupe.dedupe_union(rows, ["signature"], ["doc_id"], ["doc_id"], "sources")


@query("lineitem_dedupe", "SELECT l_orderkey, l_partkey, l_suppkey, min(l_linenumber) AS l_linenumber, list_sort(list_distinct(list(l_returnflag))) AS flags FROM lineitem GROUP BY l_orderkey, l_partkey, l_suppkey")
def lineitem_dedupe(spark, table):
    rows = table("lineitem").withColumn("flags", F.array("l_returnflag"))
    return dedupe.dedupe_union(rows, ["l_orderkey", "l_partkey", "l_suppkey"], ["l_linenumber"], ["l_linenumber"], "flags")


@query("first_wins_registry", "SELECT p_brand, arg_min(p_name, p_partkey) AS p_name FROM part GROUP BY p_brand")
def first_wins_registry(spark, table):
    return dedupe.first_per_key(table("part"), ["p_brand"], ["p_partkey"], "p_name")


@query("conflict_groups", "SELECT l_partkey, l_suppkey, count(*) AS n, count(DISTINCT (l_quantity, l_returnflag)) AS n_outcomes, count(DISTINCT (l_quantity, l_returnflag)) > 1 AS conflict FROM lineitem GROUP BY ALL")
def conflict_groups(spark, table):
    return dedupe.conflicts(table("lineitem"), ["l_partkey", "l_suppkey"], ["l_quantity", "l_returnflag"])


@query("renumber_by_prefix", "SELECT o_orderkey, o_orderpriority || '-Entry' || row_number() OVER (PARTITION BY o_orderpriority, o_custkey ORDER BY o_orderkey) AS id FROM orders")
def renumber_by_prefix(spark, table):
    return dedupe.renumber(table("orders"), ["o_orderpriority", "o_custkey"], ["o_orderkey"], F.col("o_orderpriority")).select("o_orderkey", "id")


@query("unique_suffixes", "SELECT p_brand, p_partkey, p_name, CASE WHEN n = 1 THEN p_name ELSE p_name || '_' || n END AS unique_key FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_partkey) AS n FROM part)")
def unique_suffixes(spark, table):
    return dedupe.unique_suffixes(table("part"), ["p_brand"], ["p_partkey"], "p_name")


@query(
    "merged_amounts",
    """WITH a AS (SELECT l_orderkey, l_partkey, l_suppkey, l_quantity::INTEGER::VARCHAR AS amount, min(l_linenumber) AS pos, count(*) AS k FROM lineitem GROUP BY ALL)
       SELECT l_orderkey, l_partkey, l_suppkey, min(pos) AS l_linenumber, string_agg(amount, '; ' ORDER BY pos, amount) AS amount, sum(k)::BIGINT AS n FROM a GROUP BY l_orderkey, l_partkey, l_suppkey""",
)
def merged_amounts(spark, table):
    rows = table("lineitem")
    merged = canon.merge_same_compounds(rows.withColumn("amount", F.col("l_quantity").cast("int").cast("string")), ["l_orderkey"], "l_partkey", "l_suppkey", "amount", "l_linenumber")
    n = rows.groupBy("l_orderkey", "l_partkey", "l_suppkey").agg(F.count("*").alias("n"))
    return merged.join(n, ["l_orderkey", "l_partkey", "l_suppkey"]).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "amount", "n")


# --- joins ----------------------------------------------------------------------------------------------------------
@query(
    "two_key_lookup",
    """SELECT c_custkey, coalesce(e.n_nationkey, f.n_nationkey) AS found, CASE WHEN e.n_nationkey IS NOT NULL THEN 'exact' WHEN f.n_nationkey IS NOT NULL THEN 'folded' ELSE 'none' END AS match
       FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN n_name WHEN 1 THEN lower(n_name) ELSE 'junk' || c_custkey END AS label FROM customer JOIN nation ON n_nationkey = c_nationkey)
       LEFT JOIN nation e ON e.n_name = label LEFT JOIN nation f ON lower(f.n_name) = lower(label)""",
)
def two_key_lookup(spark, table):
    nation = table("nation").select(F.lit(1).alias("scope"), F.col("n_name").alias("label"), "n_nationkey")
    k = F.col("c_custkey") % 3
    label = F.when(k == 0, F.col("n_name")).when(k == 1, F.lower("n_name")).otherwise(F.concat(F.lit("junk"), F.col("c_custkey")))
    rows = table("customer").join(table("nation"), F.col("n_nationkey") == F.col("c_nationkey")).select("c_custkey", F.lit(1).alias("scope"), label.alias("label"))
    return resolve.two_key_lookup(rows, nation, ["scope"], "label", "n_nationkey").select("c_custkey", "found", "match")


@query("unique_map_resolution", "SELECT p_partkey, CASE WHEN n = 1 THEN b END AS resolved_p_brand, CASE WHEN n = 1 THEN 'resolved' ELSE 'ambiguous' END AS resolution FROM part JOIN (SELECT p_name, p_size, count(DISTINCT p_brand) AS n, min(p_brand) AS b FROM part GROUP BY ALL) USING (p_name, p_size)")
def unique_map_resolution(spark, table):
    part = table("part")
    return resolve.resolve_symbols(part, part, ["p_name"], "p_size", ["p_brand"], ["p_partkey"]).select("p_partkey", "resolved_p_brand", "resolution")


@query("ambiguous_symbols", "SELECT p_name, p_size, count(DISTINCT p_brand) AS n_identities FROM part GROUP BY ALL HAVING count(DISTINCT p_brand) > 1")
def ambiguous_symbols(spark, table):
    return resolve.symbol_identities(table("part"), ["p_name"], "p_size", ["p_brand"], ["p_partkey"]).filter("n_identities > 1").select("p_name", "p_size", "n_identities")


@query(
    "candidate_antijoin",
    """WITH o AS (SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)), s AS (SELECT s_suppkey, s_nationkey FROM supplier), c AS (SELECT c_custkey, c_nationkey FROM customer)
       SELECT DISTINCT o_orderkey, s_suppkey FROM o JOIN c ON c_custkey = o_custkey JOIN s ON s_nationkey = c_nationkey""",
)
def candidate_antijoin(spark, table):
    c = table("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    o = table("orders").join(c, "o_custkey").select("o_orderkey", F.lit("").alias("scope"), F.col("nation").cast("string").alias("nation"))
    s = table("supplier").select("s_suppkey", F.lit("").alias("scope"), F.col("s_nationkey").cast("string").alias("nation"))
    aligned = table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return resolve.candidates(o, aligned, s, ["scope"], ["nation"], "o_orderkey", "s_suppkey").select("o_orderkey", "s_suppkey")


@query(
    "full_outer_pairing",
    """WITH c AS (SELECT c_nationkey AS nation, c_custkey, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey))::INTEGER AS n FROM customer), s AS (SELECT s_nationkey AS nation, s_suppkey, (row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey))::INTEGER AS n FROM supplier)
       SELECT coalesce(c.nation, s.nation) AS nation, coalesce(c.n, s.n) AS n, c_custkey, s_suppkey FROM c FULL JOIN s ON c.nation = s.nation AND c.n = s.n""",
)
def full_outer_pairing(spark, table):
    c, s = table("customer").select(F.col("c_nationkey").alias("nation"), "c_custkey"), table("supplier").select(F.col("s_nationkey").alias("nation"), "s_suppkey")
    return resolve.pair_by_position(c, s, "nation", ["c_custkey"], ["s_suppkey"]).select("nation", "n", "c_custkey", "s_suppkey")


@query(
    "positional_diff",
    """WITH a AS (SELECT conv_id // 2 AS pair, turn, text FROM conversations WHERE conv_id % 2 = 0), b AS (SELECT conv_id // 2 AS pair, turn, text FROM conversations WHERE conv_id % 2 = 1)
       SELECT coalesce(a.pair, b.pair) AS pair, coalesce(a.turn, b.turn) AS turn, a.text AS before, b.text AS after FROM a FULL JOIN b ON a.pair = b.pair AND a.turn = b.turn WHERE a.text IS DISTINCT FROM b.text""",
)
def positional_diff(spark, table):
    """Conversations of even ids against those of the odd ids after them, turn by turn."""
    c = table("conversations").select(F.floor(F.col("conv_id") / 2).alias("pair"), "turn", "text", (F.col("conv_id") % 2).alias("side"))
    return resolve.positional_diff(c.filter("side = 0"), c.filter("side = 1"), ["pair", "turn"], "text")


@query("alias_theta_join", "SELECT doc_id, n_name FROM documents JOIN nation ON contains(lower(text), left(lower(n_name), 3))")
def alias_theta_join(spark, table):
    aliases = table("nation").select("n_name", F.substring(F.lower("n_name"), 1, 3).alias("alias"))
    return resolve.contains_join(table("documents").select("doc_id", F.lower("text").alias("t")), aliases, "t", "alias").select("doc_id", "n_name")


@query("range_scope_join", "SELECT p_partkey, s_suppkey FROM part JOIN supplier ON p_size BETWEEN s_suppkey % 40 AND s_suppkey % 40 + 2")
def range_scope_join(spark, table):
    spans = table("supplier").select("s_suppkey", (F.col("s_suppkey") % 40).alias("lo"), (F.col("s_suppkey") % 40 + 2).alias("hi"))
    return resolve.range_join(table("part").select("p_partkey", "p_size"), spans, "p_size", "lo", "hi", 5).select("p_partkey", "s_suppkey")


@query(
    "asof_page",
    """SELECT e.event_id, c.event_id AS click_id, c.value AS click_value FROM (SELECT * FROM events WHERE event_type = 'purchase') e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON e.user_id = c.user_id AND e.ts >= c.ts""",
)
def asof_page(spark, table):
    e = table("events")
    clicks = e.filter("event_type = 'click'").select("user_id", "ts", F.col("event_id").alias("click_id"), F.col("value").alias("click_value"))
    return resolve.as_of(e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts"), clicks, ["user_id"], "ts", "event_id", "click_id", "click_value").select("event_id", "click_id", "click_value")


@query(
    "structure_memo_join",
    "SELECT p_partkey, s_acctbal AS scaffold, s_acctbal IS NOT NULL AS memo_hit FROM part LEFT JOIN supplier ON lower(s_name) = 'supplier#' || lpad((p_size * 3)::VARCHAR, 9, '0')",
)
def structure_memo_join(spark, table):
    memo = table("supplier").select("s_name", F.col("s_acctbal").alias("scaffold"))
    key = F.concat(F.lit(" Supplier#"), F.lpad((F.col("p_size") * 3).cast("string"), 9, "0"))
    return resolve.memo_join(table("part"), memo, key, "s_name", "scaffold").select("p_partkey", "scaffold", "memo_hit")


@query("memo_miss_set", "SELECT DISTINCT 'supplier#' || lpad((p_size * 3)::VARCHAR, 9, '0') AS key FROM part WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE lower(s_name) = 'supplier#' || lpad((p_size * 3)::VARCHAR, 9, '0'))")
def memo_miss_set(spark, table):
    key = F.concat(F.lit("Supplier#"), F.lpad((F.col("p_size") * 3).cast("string"), 9, "0"))
    return resolve.memo_misses(table("part"), table("supplier"), key, "s_name")


@query("memo_keys", "SELECT p_partkey, sha256(p_name || chr(10) || 'schema_v1' || chr(10) || 'prompt_v2') AS key FROM part")
def memo_keys(spark, table):
    return table("part").select("p_partkey", memo_key(F.col("p_name"), "schema_v1", "prompt_v2").alias("key"))


@query("memo_merge", "SELECT p_name, CASE WHEN bool_or(p_size % 2 = 0) THEN arg_min(p_partkey, p_partkey) FILTER (p_size % 2 = 0) ELSE max(p_partkey) END AS p_partkey FROM part GROUP BY p_name")
def memo_merge(spark, table):
    memo = table("part").select("p_name", "p_partkey", F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("scaffold"))
    return resolve.merge_memos(memo, "p_name", "scaffold", ["p_partkey"]).select("p_name", "p_partkey")


# --- graph ----------------------------------------------------------------------------------------------------------
def order_edges(table):
    """Orders as reactions: customer and parts as compounds, line by line, with amounts and steps."""
    o, line, p, c = table("orders"), table("lineitem"), table("part"), table("customer")
    # Dealt by part, so that neither the aggregate nor the join with parts shuffles the lines again.
    line = line.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag").repartition("l_partkey").groupBy("l_orderkey", "l_partkey", "l_linenumber").agg(F.min("l_quantity").alias("q"), F.min("l_returnflag").alias("flag"))
    node = F.concat(F.lit("TextReaction:"), F.col("o_orderpriority"), F.lit(":"), F.col("o_orderkey"))
    head = [node.alias("x_name"), F.lit("Reaction").alias("x_type")]
    tail = [F.col("o_orderpriority").alias("pdf_name"), node.alias("reaction_id"), F.lit("text").alias("source_modality")]
    named = line.join(p.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey")).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    relation = F.when(F.col("flag") == "R", "PRODUCES").when(F.col("flag") == "A", "USES_CATALYST").otherwise("USES_SUBSTRATE")
    parts = named.select(*head, relation.alias("relationship"), F.concat("p_name", F.lit(" "), "p_partkey").alias("y_name"), F.lit("Compound").alias("y_type"), F.col("l_linenumber").cast("string").alias("step"), F.col("q").cast("int").cast("string").alias("amount"), *tail, (F.col("p_partkey") * 10 + F.col("l_linenumber")).alias("pos"))
    buyer = o.join(c.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey")).select(*head, F.lit("USES_LIGAND").alias("relationship"), F.col("c_name").alias("y_name"), F.lit("Compound").alias("y_type"), F.lit("").alias("step"), F.lit("").alias("amount"), *tail, F.lit(0).cast("long").alias("pos"))
    kind = o.select(*head, F.lit("OF_TYPE").alias("relationship"), F.col("o_orderstatus").alias("y_name"), F.lit("ReactionType").alias("y_type"), F.lit("").alias("step"), F.lit("").alias("amount"), *tail, F.lit(-1).cast("long").alias("pos"))
    rows = parts.unionByName(buyer).unionByName(kind)
    return graph.route_amounts(rows).withColumns({c: F.lit("") for c in ("source_pages", "yield", "ee", "er", "dr", "source_image")})


_EDGES = """WITH l AS (SELECT l_orderkey, l_partkey, l_linenumber, min(l_quantity) AS q, min(l_returnflag) AS flag FROM lineitem GROUP BY ALL),
e AS (SELECT o_orderkey, o_orderpriority, CASE flag WHEN 'R' THEN 'PRODUCES' WHEN 'A' THEN 'USES_CATALYST' ELSE 'USES_SUBSTRATE' END AS relationship, p_name || ' ' || p_partkey AS y_name, l_linenumber::VARCHAR AS step, q::INTEGER::VARCHAR AS amount, p_partkey * 10 + l_linenumber AS pos
 FROM l JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
 UNION ALL SELECT o_orderkey, o_orderpriority, 'USES_LIGAND', c_name, '', '', 0 FROM orders JOIN customer ON c_custkey = o_custkey
 UNION ALL SELECT o_orderkey, o_orderpriority, 'OF_TYPE', o_orderstatus, '', '', -1 FROM orders)"""


@query(
    "edges_build",
    _EDGES + " SELECT DISTINCT 'TextReaction:' || o_orderpriority || ':' || o_orderkey AS x_name, relationship, y_name, step, CASE WHEN relationship = 'USES_SUBSTRATE' THEN amount ELSE '' END AS substrate_amount, CASE WHEN relationship = 'PRODUCES' THEN amount ELSE '' END AS product_amount, CASE WHEN relationship = 'USES_CATALYST' THEN amount ELSE '' END AS catalyst_amount FROM e",
)
def edges_build(spark, table):
    return graph.dedupe_edges(order_edges(table).select("x_name", "relationship", "y_name", "step", "substrate_amount", "product_amount", "catalyst_amount"))


@query("edge_dedupe", _EDGES + " SELECT count(*) AS edges, count(DISTINCT o_orderkey) AS reactions FROM (SELECT DISTINCT o_orderkey, relationship, y_name, step, amount FROM e)")
def edge_dedupe(spark, table):
    edges = graph.unify(order_edges(table).select(*vocab.EDGE_COLUMNS), order_edges(table).select(*vocab.EDGE_COLUMNS))
    return edges.groupBy("reaction_id").agg(F.count("*").alias("n")).agg(F.sum("n").alias("edges"), F.count("*").alias("reactions"))


@query("edge_relation_counts", _EDGES + " SELECT relationship, count(*) AS n FROM e GROUP BY relationship")
def edge_relation_counts(spark, table):
    return graph.relation_counts(order_edges(table))


@query(
    "edges_to_summary",
    _EDGES
    + """, v AS (SELECT o_orderkey, o_orderpriority, relationship, coalesce(try_cast(step AS INTEGER), 0) AS s, CASE WHEN amount = '' THEN y_name ELSE y_name || ' (' || amount || ')' END AS v, pos FROM e WHERE relationship <> 'OF_TYPE'),
f AS (SELECT o_orderkey, o_orderpriority, relationship, s, v, min(pos) AS pos FROM v GROUP BY ALL),
g AS (SELECT o_orderkey, o_orderpriority, relationship, s, string_agg(v, '; ' ORDER BY pos) AS v FROM f GROUP BY ALL),
h AS (SELECT o_orderkey, o_orderpriority, relationship, string_agg(CASE WHEN s = 0 THEN v ELSE 'step' || s || ': ' || v END, '; ' ORDER BY s) AS v FROM g GROUP BY ALL)
SELECT o_orderpriority AS paper, o_orderkey::VARCHAR AS location, coalesce(max(v) FILTER (relationship = 'USES_SUBSTRATE'), '') AS substrate, coalesce(max(v) FILTER (relationship = 'PRODUCES'), '') AS product, coalesce(max(v) FILTER (relationship = 'USES_CATALYST'), '') AS catalyst, coalesce(max(v) FILTER (relationship = 'USES_LIGAND'), '') AS ligand FROM h GROUP BY ALL""",
)
def edges_to_summary(spark, table):
    """Orders expanded to edges, and the edges folded back into a row for each order."""
    return graph.fold_edges(order_edges(table)).select("paper", "location", "substrate", "product", "catalyst", "ligand")


def _band(balance: str):
    """floor(balance / 100) as SQL writes a double: zero has a sign, and there is an exponent from 10^16 on."""
    x = F.col(balance) / 100
    text = x.cast("string")
    odd = F.when(text.isin("NaN", "Infinity", "-Infinity"), F.lower(F.replace(text, F.lit("inity"))))
    whole = F.when(text != "-0.0", F.concat(F.floor(x).cast("string"), F.lit(".0"))).otherwise(text)
    digits = F.transform(F.sequence(F.lit(0), F.lit(16)), lambda n: F.call_function("format_string", F.concat(F.lit("%."), n.cast("string"), F.lit("e")), x))
    shortest = F.try_element_at(F.filter(digits, lambda d: d.try_cast("double") == x), F.lit(1))
    return F.coalesce(odd, F.when(F.abs(x) < 1e16, whole).otherwise(shortest))


@query("entity_alignment", "SELECT DISTINCT c_custkey AS left_id, s_suppkey AS right_id, c_nationkey AS nation, floor(c_acctbal / 100)::VARCHAR AS key FROM customer JOIN supplier ON c_nationkey = s_nationkey AND floor(c_acctbal / 100) = floor(s_acctbal / 100)")
def entity_alignment(spark, table):
    c = table("customer").select(F.col("c_nationkey").alias("nation"), _band("c_acctbal").alias("key"), "c_custkey")
    zeros = F.array(F.lit("0.0"), F.lit("-0.0"))  # equal as numbers, and the key is the customer's text
    key = _band("s_acctbal")
    s = table("supplier").select(F.col("s_nationkey").alias("nation"), F.explode(F.when(key.isin("0.0", "-0.0"), zeros).otherwise(F.array(key))).alias("key"), "s_suppkey")
    return resolve.same_as(c, s, ["nation"], "key", "c_custkey", "s_suppkey")


@query("condition_split", "SELECT o_orderkey, ['temp: ' || o_custkey % 90, 'time: ' || o_custkey % 24 || ' h, dry', 'solvent: THF'] AS parts FROM orders")
def condition_split(spark, table):
    n = lambda k: (F.col("o_custkey") % k).cast("string")
    text = F.concat(F.lit("temp: "), n(90), F.lit("; time: "), n(24), F.lit(" h, dry, solvent: THF"))
    return table("orders").select("o_orderkey", graph.split_condition(text).alias("parts"))


# --- questions ------------------------------------------------------------------------------------------------------
_OPTIONS = """WITH o AS (SELECT l_partkey, l_returnflag, l_suppkey, l_quantity, l_linenumber, l_quantity >= 5 AS e, l_quantity >= 8 AS s, l_linestatus = 'F' AS r FROM lineitem),
m AS (SELECT l_partkey, l_returnflag, l_suppkey, count(*) AS n, count(DISTINCT (l_quantity, r)) AS k, arg_min((r, l_quantity), lpad(l_linenumber::VARCHAR, 3, '0') || (l_quantity + 100)::VARCHAR || r) AS v, min(l_suppkey::VARCHAR) AS id FROM o WHERE e AND s GROUP BY ALL),
g AS (SELECT l_partkey, l_returnflag, count(*) AS n_all, count(*) FILTER (e) AS n_e, count(*) FILTER (e AND s) AS n_s FROM o GROUP BY ALL),
q AS (SELECT l_partkey, l_returnflag, count(*) AS n_options, count(*) FILTER (v[1]) AS n_r, max(v[2]) FILTER (v[1]) AS best FROM m WHERE k = 1 GROUP BY ALL),
z AS (SELECT g.*, coalesce(n_options, 0) AS n_options, coalesce(n_r, 0) AS n_r, best, CASE WHEN n_e < 2 THEN 'insufficient_objective_options' WHEN n_s < 2 THEN 'insufficient_scored_options' WHEN coalesce(n_options, 0) < 2 THEN 'insufficient_distinct_conditions' WHEN n_r = 0 THEN 'no_rankable_yield_or_ee' END AS reason FROM g LEFT JOIN q USING (l_partkey, l_returnflag))"""


def _options(table):
    return questions.build(
        table("lineitem").withColumn("k", F.col("l_suppkey")), ["l_partkey", "l_returnflag"], ["l_suppkey"], ["l_quantity", "l_linestatus"],
        F.col("l_linestatus") == "F", F.col("l_quantity"), "k", F.col("l_quantity") >= 5, F.col("l_quantity") >= 8,
    )


@query("qa_gold_ties", _OPTIONS + " SELECT z.l_partkey, z.l_returnflag, z.n_options, z.best, list(m.id ORDER BY m.id) AS gold, z.n_options >= 3 AS top3 FROM z JOIN m ON m.l_partkey = z.l_partkey AND m.l_returnflag = z.l_returnflag AND m.k = 1 AND m.v[1] AND m.v[2] = z.best WHERE reason IS NULL GROUP BY ALL")
def qa_gold_ties(spark, table):
    return _options(table)[0].select("l_partkey", "l_returnflag", "n_options", "best", "gold", "top3")


@query("qa_ranked_options", _OPTIONS + " SELECT z.l_partkey, z.l_returnflag, list(m.id ORDER BY NOT m.v[1], -m.v[2], m.id) AS ranked FROM z JOIN m ON m.l_partkey = z.l_partkey AND m.l_returnflag = z.l_returnflag AND m.k = 1 WHERE reason IS NULL GROUP BY ALL")
def qa_ranked_options(spark, table):
    return _options(table)[0].select("l_partkey", "l_returnflag", "ranked")


@query("qa_review_reasons", _OPTIONS + " SELECT reason, count(*) AS n FROM (SELECT reason FROM z WHERE reason IS NOT NULL UNION ALL SELECT 'duplicate_public_conditions_conflicting_results' FROM m WHERE k > 1) GROUP BY reason")
def qa_review_reasons(spark, table):
    return reports.distribution(_options(table)[1], "reason")


@query("qa_group_guard", _OPTIONS + " SELECT l_partkey, l_returnflag, reason, n_all AS n FROM z WHERE reason IS NOT NULL")
def qa_group_guard(spark, table):
    return _options(table)[1].filter("reason <> 'duplicate_public_conditions_conflicting_results'")


@query("qa_conflict_dedupe", _OPTIONS + " SELECT l_partkey, l_returnflag, count(*) AS dropped, sum(n)::BIGINT AS n_rows FROM m WHERE k > 1 GROUP BY ALL")
def qa_conflict_dedupe(spark, table):
    clash = _options(table)[1].filter("reason = 'duplicate_public_conditions_conflicting_results'")
    return clash.groupBy("l_partkey", "l_returnflag").agg(F.count("*").alias("dropped"), F.sum("n").alias("n_rows"))


@query("qa_top3", _OPTIONS + " SELECT n_options, n_options >= 3 AS top3, count(*) AS n FROM z WHERE reason IS NULL GROUP BY ALL")
def qa_top3(spark, table):
    return _options(table)[0].groupBy("n_options", "top3").agg(F.count("*").alias("n"))


@query(
    "qa_window_ranks",
    """SELECT p_partkey, (row_number() OVER (PARTITION BY p_brand ORDER BY (p_size > 10) DESC, p_size DESC, p_partkey::VARCHAR))::INTEGER AS rank, p_size > 10 AND p_size = max(p_size) FILTER (p_size > 10) OVER (PARTITION BY p_brand) AS is_gold FROM part""",
)
def qa_window_ranks(spark, table):
    return questions.rank_options(table("part"), ["p_brand"], F.col("p_size") > 10, F.col("p_size"), "p_partkey").select("p_partkey", "rank", "is_gold")


@query("qa_shuffle", "SELECT p_partkey, 'O' || row_number() OVER (PARTITION BY p_brand ORDER BY sha256('seed|' || p_brand || '|' || p_partkey)) AS option_id FROM part")
def qa_shuffle(spark, table):
    return questions.shuffled(table("part"), ["p_brand"], F.col("p_partkey"), "seed").select("p_partkey", "option_id")


@query("scaffold_unpivot", "SELECT p_partkey, unnest(list_sort(list_distinct(string_split(p_type, ' ')))) AS scaffold FROM part")
def scaffold_unpivot(spark, table):
    return table("part").select("p_partkey", F.explode(F.array_sort(F.array_distinct(F.split("p_type", " ")))).alias("scaffold"))


# --- windows and sequences ------------------------------------------------------------------------------------------
@query("section_lead", "SELECT conv_id, turn, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS end_page FROM conversations")
def section_lead(spark, table):
    return sections.section_ends(table("conversations"), ["conv_id"], "turn").select("conv_id", "turn", "end_page")


@query("fixed_chunk", "SELECT conv_id, turn, ((row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 3)::INTEGER AS chunk FROM conversations")
def fixed_chunk(spark, table):
    return sections.fixed_chunks(table("conversations"), ["conv_id"], ["turn"], 3).select("conv_id", "turn", "chunk")


@query(
    "greedy_chunk",
    """WITH RECURSIVE r AS (SELECT conv_id, turn, length(text) AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations),
       w AS (SELECT conv_id, turn, i, 0 AS chunk, 1 AS n, c AS chars FROM r WHERE i = 1
       UNION ALL SELECT r.conv_id, r.turn, r.i, CASE WHEN w.n >= 3 OR w.chars + r.c > 1500 THEN w.chunk + 1 ELSE w.chunk END, CASE WHEN w.n >= 3 OR w.chars + r.c > 1500 THEN 1 ELSE w.n + 1 END, CASE WHEN w.n >= 3 OR w.chars + r.c > 1500 THEN r.c ELSE w.chars + r.c END FROM w JOIN r ON r.conv_id = w.conv_id AND r.i = w.i + 1)
       SELECT conv_id, chunk, list(turn ORDER BY turn) AS orders, max(chars) AS chars FROM w GROUP BY conv_id, chunk""",
)
def greedy_chunk(spark, table):
    return sections.greedy_chunks(table("conversations"), ["conv_id"], "turn", F.char_length("text"), 3, 1500)


@query("page_pairs", "SELECT conv_id, turn, 'page' AS kind, text FROM conversations UNION ALL SELECT * FROM (SELECT conv_id, turn, 'pair', text || chr(10) || lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS text FROM conversations) WHERE text IS NOT NULL")
def page_pairs(spark, table):
    return sections.page_pairs(table("conversations"), ["conv_id"], "turn", "text")


@query("text_spans", None)
def text_spans(spark, table):
    """Parts of documents that begin with a line of just one word."""
    return sections.spans_of(table("documents").select("doc_id", "text"), ["doc_id"], r"(?m)^\w+\.$", near=20)


@query("top_k_slowest", "SELECT event_id, event_type, value FROM events ORDER BY value DESC, event_id LIMIT 20")
def top_k_slowest(spark, table):
    return sections.top_k(table("events"), 20, F.col("value").desc(), F.col("event_id")).select("event_id", "event_type", "value")


# --- sets -----------------------------------------------------------------------------------------------------------
@query(
    "overlap_counts",
    """WITH a AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 50), b AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag = 'N' AND l_quantity >= 50)
       SELECT (SELECT count(*) FROM (FROM a EXCEPT FROM b)) AS left_only, (SELECT count(*) FROM (FROM b EXCEPT FROM a)) AS right_only, (SELECT count(*) FROM (FROM a INTERSECT FROM b)) AS both""",
)
def overlap_counts(spark, table):
    line = table("lineitem").filter("l_quantity >= 50")
    return questions.overlap(line.filter("l_returnflag = 'R'"), line.filter("l_returnflag = 'N'"), "l_partkey")


@query("set_equality", "SELECT o.l_orderkey, list_sort(list_distinct(list(l_partkey % 5))) = list_sort(list_distinct(list(l_suppkey % 5))) AS same FROM lineitem o GROUP BY ALL")
def set_equality(spark, table):
    names = lambda c: F.array_sort(F.collect_set(F.col(c) % 5))
    return table("lineitem").groupBy("l_orderkey").agg((names("l_partkey") == names("l_suppkey")).alias("same"))


@query("uncovered_orders", "SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def uncovered_orders(spark, table):
    return resolve.uncovered(table("orders").select("o_orderkey"), table("lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


@query("bundle_violations", "SELECT p_name AS key, 'repeated_id' AS violation FROM part GROUP BY p_name HAVING count(*) > 1 UNION ALL SELECT p_name, 'gold_not_an_option' FROM part WHERE p_size > 40")
def bundle_violations(spark, table):
    part = table("part").select(F.col("p_name").alias("key"), F.array(F.lit("O1"), F.lit("O2")).alias("options"), F.array(F.when(F.col("p_size") > 40, "O9").otherwise("O1")).alias("gold"))
    return filters.violations(part, "key", "options", "gold")


# --- reports --------------------------------------------------------------------------------------------------------
@query(
    "usage_grouping_sets",
    """SELECT CASE WHEN grouping(event_type) = 0 THEN 'model' WHEN grouping(stage) = 0 THEN 'stage' WHEN grouping(pdf) = 0 THEN 'pdf_name' ELSE 'total' END AS by, coalesce(event_type, stage, pdf) AS value, count(*) AS calls, sum(k)::BIGINT AS prompt_tokens, sum(u)::BIGINT AS completion_tokens, sum(k + u)::BIGINT AS total_tokens
       FROM (SELECT event_type, (event_id % 4)::VARCHAR AS stage, user_id::VARCHAR AS pdf, json_extract_string(props, '$.k')::BIGINT AS k, user_id AS u FROM events) GROUP BY GROUPING SETS ((), (event_type), (stage), (pdf))""",
)
def usage_grouping_sets(spark, table):
    rows = table("events").select(F.col("event_type").alias("model"), (F.col("event_id") % 4).cast("string").alias("stage"), F.col("user_id").cast("string").alias("pdf_name"), F.get_json_object("props", "$.k").cast("long").alias("input_tokens"), F.col("user_id").alias("completion_tokens"))
    return reports.usage(rows)


# Seconds are whole here, so that sums don't depend on the order in which an engine adds them.
@query(
    "timing_rollup",
    """SELECT CASE WHEN grouping(event_type) = 0 THEN 'event_type' WHEN grouping(user_id) = 0 THEN 'user_id' ELSE 'total' END AS by, coalesce(event_type, user_id::VARCHAR) AS value, count(*) AS calls, sum(floor(value)) AS seconds, max(floor(value)) AS longest FROM events GROUP BY GROUPING SETS ((), (event_type), (user_id))""",
)
def timing_rollup(spark, table):
    return reports.timing(table("events").withColumn("value", F.floor("value").cast("double")), ("event_type", "user_id"), "value")


@query(
    "image_overhead",
    """SELECT user_id, coalesce(sum(floor(value)) FILTER (event_type <> 'click'), 0) AS wall, coalesce(sum(floor(value)) FILTER (event_type = 'click'), 0) AS leaf, coalesce(sum(floor(value)) FILTER (event_type <> 'click'), 0) - coalesce(sum(floor(value)) FILTER (event_type = 'click'), 0) AS overhead FROM events GROUP BY user_id""",
)
def image_overhead(spark, table):
    kind = reports.event_kind(F.lit(""), F.col("event_type"), ("click",))
    rows = table("events").select("user_id", kind.alias("event_kind"), F.floor("value").cast("double").alias("value"))
    return reports.overhead(rows, ["user_id"], "event_kind", "value")


@query(
    "gpu_summary",
    """SELECT s_nationkey AS gpu_index, count(*) AS samples, max(m) AS max_memory_used, round_even(avg(m), 2) AS avg_memory_used, max(u) AS max_utilization, round_even(avg(u), 2) AS avg_utilization, max(p) AS max_power, round_even(avg(p), 2) AS avg_power
       FROM (SELECT s_nationkey, s_suppkey AS m, s_suppkey % 7 AS u, s_suppkey % 5 AS p FROM supplier) GROUP BY ROLLUP (s_nationkey)""",
)
def gpu_summary(spark, table):
    s = table("supplier").select(F.col("s_nationkey").alias("gpu_index"), F.col("s_suppkey").alias("memory_used"), (F.col("s_suppkey") % 7).alias("utilization"), (F.col("s_suppkey") % 5).alias("power"))
    return reports.gpu_summary(s)


@query(
    "paper_summary",
    """SELECT n_name AS paper, modality, coalesce(n, 0) AS n_questions, coalesce(b, 0) AS n_BUILDING, coalesce(m, 0) AS n_MACHINERY FROM nation LEFT JOIN (SELECT c_nationkey, (c_custkey % 2)::VARCHAR AS modality, count(*) AS n, count(*) FILTER (c_mktsegment = 'BUILDING') AS b, count(*) FILTER (c_mktsegment = 'MACHINERY') AS m FROM customer GROUP BY ALL) ON c_nationkey = n_nationkey""",
)
def paper_summary(spark, table):
    nation = table("nation").select(F.col("n_name").alias("paper"), F.col("n_nationkey").alias("c_nationkey"))
    rows = table("customer").join(nation, "c_nationkey").withColumn("modality", (F.col("c_custkey") % 2).cast("string"))
    return reports.paper_summary(rows, nation.select("paper"), "paper", "modality", "c_mktsegment", ("BUILDING", "MACHINERY"))


@query("label_examples", "SELECT lang, source, count(*) AS n, list(doc_id ORDER BY doc_id)[1:3] AS examples FROM documents GROUP BY lang, source")
def label_examples(spark, table):
    return reports.label_examples(table("documents").withColumn("id", F.col("doc_id")), ["lang", "source"], "doc_id", "id")


@query("cost_estimate", "SELECT model, prompt_tokens, completion_tokens, (prompt_tokens * i + completion_tokens * o) / 1e6 AS usd FROM (SELECT CASE WHEN event_id % 2 = 0 THEN 'gpt-4o' ELSE 'gpt-5-mini' END AS model, sum(user_id)::BIGINT AS prompt_tokens, count(*) AS completion_tokens FROM events GROUP BY 1) JOIN (VALUES ('gpt-4o', 2.5, 10.0), ('gpt-5-mini', 0.25, 2.0)) p(m, i, o) ON m = model")
def cost_estimate(spark, table):
    model = F.when(F.col("event_id") % 2 == 0, "gpt-4o").otherwise("gpt-5-mini")
    rows = table("events").groupBy(model.alias("model")).agg(F.sum("user_id").alias("prompt_tokens"), F.count("*").alias("completion_tokens"))
    return reports.cost(rows, reports.default_prices(spark))


@query("type_audit", "SELECT l_partkey, list_sort(list_distinct(list(l_returnflag))) AS types, count(DISTINCT l_returnflag) > 1 AS type_conflict FROM lineitem GROUP BY l_partkey")
def type_audit(spark, table):
    return reports.type_audit(table("lineitem"), ["l_partkey"], "l_returnflag")


@query("status_counts", "SELECT o_orderpriority AS file, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O FROM orders GROUP BY ROLLUP (o_orderpriority)")
def status_counts(spark, table):
    return reports.status_counts(table("orders").withColumn("file", F.col("o_orderpriority")), "o_orderstatus", ("F", "O"), "file")


@query("scaffold_top10", "SELECT lower(p_type) AS scaffold, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, scaffold LIMIT 10")
def scaffold_top10(spark, table):
    counts = table("part").groupBy(F.lower("p_type").alias("scaffold")).agg(F.count("*").alias("n"))
    return sections.top_k(counts, 10, F.col("n").desc(), F.col("scaffold"))


@query("benchmark_containment", "SELECT item_id, count(*) AS n FROM benchmark JOIN documents ON contains(documents.text, benchmark.text) GROUP BY item_id")
def benchmark_containment(spark, table):
    items = table("benchmark").select("item_id", F.col("text").alias("alias"))
    return resolve.contains_join(table("documents").select("doc_id", "text"), items, "text", "alias").groupBy("item_id").agg(F.count("*").alias("n"))


@query("registry_reasons", "SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'empty' WHEN p_size % 5 = 1 THEN 'generic' WHEN p_size % 5 = 2 THEN 'name_is_symbol' WHEN p_size % 5 = 3 THEN 'descriptor_and_label' END AS reason FROM part")
def registry_reasons(spark, table):
    k, n = F.col("p_size") % 5, F.col("p_partkey").cast("string")
    name = F.when(k == 0, "None").when(k == 1, "Ligand").when(k == 2, F.concat(F.lit("("), n, F.lit(") "))).when(k == 3, "substrate 3a").otherwise("tetrahydrofuran ring")
    return table("part").select("p_partkey", filters.registry_reason(n, name).alias("reason"))


@query("clean_lists", "SELECT p_partkey, p_name || ' ' || p_brand AS symbol_text, p_name || '; ' || p_brand AS image_text, p_name || ', Unknown, ' || p_brand AS graph_text FROM part")
def clean_lists(spark, table):
    """One list under the vocabularies and glues of its three users."""
    items = F.array(F.col("p_name"), F.lit("None"), F.lit(" "), F.lit("Unknown"), F.col("p_brand"))
    some = F.array(F.col("p_name"), F.lit("null"), F.col("p_brand"))
    return table("part").select("p_partkey", t.clean_list(items, " ", vocab.SYMBOL_EMPTY).alias("symbol_text"), t.clean_list(some, "; ").alias("image_text"), t.clean_list(items).alias("graph_text"))
