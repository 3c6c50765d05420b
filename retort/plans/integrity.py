"""General procedures and invariants."""

from __future__ import annotations

from pyspark.sql import functions as F

from retort.operators import procedures, validation
from retort.plans.base import query


@query("gp_alias_match", "SELECT doc_id, r_name AS gp_key, lower(left(r_name, 2)) AS alias FROM documents JOIN region ON contains(lower(text), lower(left(r_name, 2)))")
def gp_alias_match(spark, table):
    gp = table("region").select(F.col("r_name").alias("gp_key"), F.col("r_regionkey").alias("pos"), F.lower(F.substring("r_name", 1, 2)).alias("alias"))
    return procedures.match_aliases(table("documents").select("doc_id", "text"), gp).select("doc_id", "gp_key", "alias")


@query("gp_titles", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_size::VARCHAR END AS key FROM part")
def gp_titles(spark, table):
    n = F.col("p_size").cast("string")
    title = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("2.1 General  Procedure "), n, F.lit(": coupling"))).otherwise("Materials")
    return table("part").select("p_partkey", procedures.gp_key(title).alias("key"))


@query("gp_scope", "SELECT p_partkey, (SELECT arg_min(r_name, r_regionkey) FROM region WHERE p_size BETWEEN r_regionkey * 8 AND r_regionkey * 8 + 12) AS gp_key FROM part")
def gp_scope(spark, table):
    scopes = table("region").select(F.col("r_name").alias("gp_key"), F.col("r_regionkey").alias("pos"), (F.col("r_regionkey") * 8).alias("low"), (F.col("r_regionkey") * 8 + 12).alias("high"))
    return procedures.in_scope(table("part").select("p_partkey", F.col("p_size").alias("number")), scopes).select("p_partkey", "gp_key")


@query("template_override", "SELECT n_nationkey, n_name AS name, r_name AS region, CASE WHEN n_nationkey % 2 = 0 THEN 'own' ELSE 'base' END AS kind FROM nation JOIN region ON r_regionkey = n_regionkey")
def template_override(spark, table):
    base = table("region").select(F.col("r_regionkey").alias("k"), F.create_map(F.lit("region"), "r_name", F.lit("kind"), F.lit("base")).alias("fields"))
    own = F.map_from_entries(F.filter(F.array(F.struct(F.lit("name").alias("k"), F.col("n_name").alias("v")), F.struct(F.lit("kind").alias("k"), F.when(F.col("n_nationkey") % 2 == 0, "own").alias("v"))), lambda e: e["v"].isNotNull()))
    out = procedures.override(base, table("nation").select("n_nationkey", F.col("n_regionkey").alias("k"), own.alias("fields")), ["k"])
    return out.select("n_nationkey", *[F.col("fields")[x].alias(x) for x in ("name", "region", "kind")])


@query(
    "span_pages",
    "SELECT o_orderkey, list_sort(list_distinct(list_concat(list(l_linenumber::INTEGER) FILTER (l_linenumber > 2), [max(l_linenumber::INTEGER) FILTER (l_linenumber <= 2)]))) AS pages FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_linenumber < 5 GROUP BY o_orderkey HAVING max(l_linenumber) FILTER (l_linenumber <= 2) IS NOT NULL",
)
def span_pages(spark, table):
    spans = table("orders").select("o_orderkey", F.lit(0).alias("span_id"), F.lit(2).alias("start"), F.lit(5).alias("end"))
    marks = table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("at"), F.col("l_linenumber").cast("int").alias("page"))
    has = marks.filter("at <= 2").select("o_orderkey").distinct()
    return procedures.span_pages(spans.join(has, "o_orderkey", "left_semi"), marks, ["o_orderkey"]).select("o_orderkey", "pages")


@query(
    "role_comparison",
    """SELECT coalesce(a.c_custkey, b.c_custkey) AS id, b.c_mktsegment AS baseline_role, a.c_mktsegment AS role, CASE WHEN b.c_custkey IS NULL THEN 'added' WHEN a.c_custkey IS NULL THEN 'removed' WHEN a.c_mktsegment = b.c_mktsegment THEN 'same' ELSE 'changed' END AS change
       FROM (SELECT * FROM customer WHERE c_custkey % 3 <> 0) a FULL JOIN (SELECT c_custkey + 1 AS c_custkey, c_mktsegment FROM customer) b ON a.c_custkey = b.c_custkey""",
)
def role_comparison(spark, table):
    c = table("customer")
    now = c.filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("role"))
    return validation.compare_roles(now, c.select((F.col("c_custkey") + 1).alias("id"), F.col("c_mktsegment").alias("role")), ["id"])


@query("count_mismatches", "SELECT o_orderkey, 4 AS stored, n AS actual FROM (SELECT o_orderkey FROM orders) LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE n IS DISTINCT FROM 4")
def count_mismatches(spark, table):
    stored = table("orders").select("o_orderkey", F.lit(4).alias("n_options"))
    return validation.count_mismatches(stored, table("lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")


@query("coverage_check", "SELECT l_orderkey, list_sort(list_distinct([x FOR x IN [1, 2, 3, 4] IF NOT list_contains(list(l_linenumber), x)])) AS missing, list_sort(list_distinct([x FOR x IN list(l_linenumber) IF x > 4])) AS unexpected FROM lineitem GROUP BY l_orderkey")
def coverage_check(spark, table):
    expected = F.array(*[F.lit(i) for i in range(1, 5)])
    c = validation.coverage(expected, F.col("seen"))
    rows = table("lineitem").groupBy("l_orderkey").agg(F.collect_set(F.col("l_linenumber").cast("int")).alias("seen"))
    return rows.select("l_orderkey", c["missing"].alias("missing"), c["unexpected"].alias("unexpected"))


@query("rebind_inputs", "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'new/' || page_id || '.json' END AS file FROM pages")
def rebind_inputs(spark, table):
    old = table("pages").select("page_id", F.concat(F.lit("old\\dir/"), F.col("page_id"), F.lit(".json")).alias("path"))
    new = table("pages").filter("page_id % 2 = 0").select(F.concat(F.lit("new/"), F.col("page_id"), F.lit(".json")).alias("path"))
    return validation.rebind(old, new).select("page_id", "file")


@query("objective_fan_out", "SELECT o_orderkey, objective FROM orders, (VALUES ('combined_ee_yield'), ('yield_only')) t(objective) WHERE o_orderstatus IN ('F', 'O')")
def objective_fan_out(spark, table):
    return validation.fan_out(table("orders").withColumn("source_modality", F.col("o_orderstatus")), ("F", "O"), ("combined_ee_yield", "yield_only")).select("o_orderkey", "objective")


@query("reusable_outputs", "SELECT o_orderkey AS id, o_orderkey % 3 <> 0 AND o_orderstatus <> 'P' AND o_orderkey % 5 <> 0 AS reuse FROM orders")
def reusable_outputs(spark, table):
    o = table("orders").withColumn("id", F.col("o_orderkey"))
    hash_ = lambda x: F.sha2(x.cast("string"), 256)
    inputs = o.select("id", F.create_map(F.lit("v"), F.lit("1")).alias("metadata"), hash_(F.col("id")).alias("input_sha256"))
    outputs = o.filter("id % 3 <> 0").select("id", F.create_map(F.lit("v"), F.when(F.col("id") % 5 == 0, "2").otherwise("1")).alias("metadata"), (F.col("o_orderstatus") == "P").alias("is_partial"), hash_(F.col("id")).alias("input_sha256"))
    return validation.reusable(outputs, inputs, "id")


@query("router_jobs", "SELECT c_custkey, lower(c_mktsegment) AS route FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def router_jobs(spark, table):
    rows = table("customer").select("c_custkey", F.col("c_mktsegment").alias("route"), F.col("c_name").alias("paper_key"))
    return validation.router_jobs(rows, ("building", "machinery")).select("c_custkey", "route")
