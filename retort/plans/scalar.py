"""Normalisers, metrics and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from retort.functions import metrics as m
from retort.functions import text as t
from retort.functions import vocab
from retort.operators import filters
from retort.plans.base import query

_list = lambda words: ", ".join("'" + w.replace("'", "''") + "'" for w in words)
_count = lambda col, w: f"(length({col}) - length(replace({col}, '{w}', ''))) / {len(w)}"
_SCORE = "(" + " + ".join([*(f"3 * {_count('t', w)}" for w in vocab.QUANTITATIVE_WORDS), *(_count("t", w) for w in vocab.CHEMISTRY_WORDS)]) + ")::INTEGER"


@query("page_relevance", f"SELECT doc_id, {_SCORE} AS score, {_SCORE} >= {vocab.PAGE_THRESHOLD} AS relevant FROM (SELECT doc_id, lower(text) AS t FROM documents)")
def page_relevance(spark, table):
    # Counted in a batch of its own, so that the comparison reads the number and doesn't count again.
    scored = table("documents").select("doc_id", t.page_score(F.col("text")).alias("score"))
    return scored.select("doc_id", "score", (F.col("score") >= vocab.PAGE_THRESHOLD).alias("relevant"))


@query("page_relevance_html", f"SELECT page_id, {_SCORE} AS score FROM (SELECT page_id, lower(html) AS t FROM pages)")
def page_relevance_html(spark, table):
    return table("pages").select("page_id", t.page_score(F.col("html")).alias("score"))


_CLEAN = r"CASE WHEN lower(regexp_replace({0}, '^\s+|\s+$', '', 'g')) IN (" + _list(vocab.KG_EMPTY) + r") OR {0} IS NULL THEN '' ELSE regexp_replace(regexp_replace({0}, '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g') END"


@query("clean_text_norm", f"SELECT doc_id, {_CLEAN.format('text')} AS cleaned FROM documents")
def clean_text_norm(spark, table):
    return table("documents").select("doc_id", t.clean_text(F.col("text")).alias("cleaned"))


@query("clean_part_names", f"SELECT p_partkey, {_CLEAN.format('p_name')} AS name, lower({_CLEAN.format('p_type')}) AS kind FROM part")
def clean_part_names(spark, table):
    return table("part").select("p_partkey", t.clean_text(F.col("p_name")).alias("name"), t.normalize_iupac(F.col("p_type")).alias("kind"))


@query("normalize_symbol", "SELECT c_custkey, regexp_replace(lower(c_name), '[^a-z0-9]+', '', 'g') AS symbol FROM customer")
def normalize_symbol(spark, table):
    return table("customer").select("c_custkey", t.normalize_symbol(F.col("c_name")).alias("symbol"))


@query("main_token", "SELECT p_partkey, trim(split_part(p_type, ' ', 1)) AS token FROM part")
def main_token(spark, table):
    return table("part").select("p_partkey", t.main_token(F.replace(F.col("p_type"), F.lit(" "), F.lit(" ; "))).alias("token"))


@query("reliable_names", "SELECT s_suppkey, CASE WHEN regexp_replace(lower(s_name), '[^a-z0-9]+', '', 'g') = 'supplier' || lpad(s_suppkey::VARCHAR, 9, '0') THEN '' ELSE s_name END AS name FROM supplier")
def reliable_names(spark, table):
    symbol = F.concat(F.lit("SUPPLIER"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0"))
    return table("supplier").select("s_suppkey", t.reliable_name(F.col("s_name"), symbol, F.lit(None).cast("string")).alias("name"))


@query("smiles_like", r"SELECT p_partkey, p_brand NOT LIKE '% %' AND (regexp_matches(p_brand, '[/\\=#\[\]@+]') OR regexp_matches(p_brand, '[cnops][0-9]') OR regexp_matches(p_brand, '[0-9].*[cnops]|[cnops].*[0-9]') OR length(p_brand) >= 3 AND regexp_full_match(p_brand, '[BCNOFPSIclbrH0-9().-]+')) AS smiles FROM part")
def smiles_like(spark, table):
    return table("part").select("p_partkey", t.looks_like_smiles(F.col("p_brand")).alias("smiles"))


@query("percent_parse", "SELECT l_orderkey, l_linenumber, l_quantity, l_discount, CASE WHEN l_quantity BETWEEN 0 AND 100 THEN l_quantity END AS plain, round(l_discount * 100) AS discount, NULL::DOUBLE AS two FROM lineitem")
def percent_parse(spark, table):
    q, d = F.col("l_quantity").cast("int").cast("string"), F.round(F.col("l_discount") * 100).cast("int").cast("string")
    return table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount",
        m.parse_percentage(F.concat(F.lit("> "), q, F.lit("% yield"))).alias("plain"),
        m.parse_percentage(F.concat(F.lit("≥"), d)).alias("discount"),
        m.parse_percentage(F.concat(q, F.lit("% and "), d, F.lit("%"))).alias("two"),
    )


@query(
    "er_to_ee",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_tax,
       CASE WHEN q + r > 0 AND NOT (l_returnflag = 'R' AND q < r) THEN abs(q - r) / (q + r) * 100 END AS ee,
       CASE WHEN q + r <= 0 THEN 'invalid_ratio' WHEN l_returnflag = 'R' AND q < r THEN 'invalid_qualified_ratio' WHEN l_returnflag = 'R' THEN 'converted_threshold' ELSE 'converted_exact' END AS status
       FROM (SELECT *, round(l_tax * 100) * 10 AS r, l_quantity AS q FROM lineitem)""",
)
def er_to_ee(spark, table):
    whole = lambda c: c.cast("int").cast("string")
    text = F.concat(F.when(F.col("l_returnflag") == "R", ">").otherwise(""), whole(F.col("l_quantity")), F.lit(":"), whole(F.round(F.col("l_tax") * 100) * 10), F.lit(" er"))
    er = m.parse_er(text)
    return table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", er["ee"].alias("ee"), er["status"].alias("status"))


@query(
    "conversion_status_counts",
    """SELECT status, count(*) AS n FROM (SELECT CASE WHEN l_returnflag = 'A' THEN 'no_er' WHEN l_returnflag = 'R' THEN 'existing_ee' WHEN l_linestatus = 'F' THEN 'ambiguous_multiple_ratios' ELSE 'converted_exact' END AS status FROM lineitem) GROUP BY status""",
)
def conversion_status_counts(spark, table):
    q = F.col("l_quantity").cast("int").cast("string")
    er = F.when(F.col("l_returnflag") == "A", "Not reported").when(F.col("l_linestatus") == "F", F.concat(q, F.lit(":4; "), q, F.lit(":12"))).otherwise(F.concat(q, F.lit(":7")))
    ee = F.when(F.col("l_returnflag") == "R", "N/A").otherwise("")
    return table("lineitem").select(m.convert_er(ee, er)["status"].alias("status")).groupBy("status").agg(F.count("*").alias("n"))


@query(
    "metric_extract",
    """SELECT event_id, CASE WHEN v % 3 = 0 THEN v || '%' WHEN v % 3 = 1 THEN '' ELSE v || ' %' END AS yield, CASE WHEN v % 3 = 1 THEN v || '%' ELSE '' END AS ee
       FROM (SELECT event_id, json_extract_string(props, '$.k')::INTEGER AS v FROM events)""",
)
def metric_extract(spark, table):
    v = F.get_json_object("props", "$.k")
    k = v.cast("int") % 3
    text = F.when(k == 0, F.concat(F.lit("isolated in yield: "), v, F.lit("%"))).when(k == 1, F.concat(v, F.lit("% ee"))).otherwise(F.concat(v, F.lit(" % isolated")))
    return table("events").select("event_id", m.extract_metric(text, "yield").alias("yield"), m.extract_metric(text, "ee").alias("ee"))


@query(
    "ratio_cleanup",
    "SELECT p_partkey, '>' || p_size || ':1' AS dr, p_size || ':5' AS er, p_size >= 1 AS whole FROM part",
)
def ratio_cleanup(spark, table):
    n = F.col("p_size").cast("string")
    dr, er = m.clean_ratio(F.concat(F.lit("  >"), n, F.lit(":1 dr  ")), "dr"), m.clean_ratio(F.concat(F.lit("er = "), n, F.lit(":5")), "er")
    return table("part").select("p_partkey", dr.alias("dr"), er.alias("er"), m.whole_ratio(dr).alias("whole"))


@query(
    "objective_scores",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, CASE WHEN l_returnflag = 'A' THEN 'missing_or_invalid_yield' WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'ambiguous_er_without_ee' WHEN l_returnflag = 'N' THEN 'missing_or_invalid_ee' ELSE 'eligible' END AS combined,
       CASE WHEN l_returnflag = 'R' THEN (l_quantity + round(l_discount * 100)) / 2 END AS score,
       CASE WHEN l_returnflag = 'A' THEN 'missing_or_invalid_yield' WHEN l_returnflag = 'R' THEN 'has_ee' WHEN l_linestatus = 'F' THEN 'ambiguous_er_without_ee' ELSE 'eligible' END AS yield_only FROM lineitem""",
)
def objective_scores(spark, table):
    q, d = F.col("l_quantity").cast("int").cast("string"), F.round(F.col("l_discount") * 100).cast("int").cast("string")
    flag = F.col("l_returnflag")
    y = F.when(flag != "A", F.concat(q, F.lit("%")))
    ee = F.when(flag != "N", F.concat(d, F.lit("%")))
    er = F.when(F.col("l_linestatus") == "F", "95:5 / 90:10")
    return table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", m.eligibility(y, ee, er, m.COMBINED).alias("combined"), m.score(y, ee, er, m.COMBINED).alias("score"), m.eligibility(y, ee, er, m.YIELD_ONLY).alias("yield_only"))


@query(
    "grouping_text",
    "SELECT o_orderkey, o_custkey % 24 || ' h ' || o_custkey % 90 || 'deg c ' || o_custkey % 7 || ' mol %' AS condition FROM orders",
)
def grouping_text(spark, table):
    n = lambda k: (F.col("o_custkey") % k).cast("string")
    text = F.concat(F.lit(" ("), n(24), F.lit(" Hours), "), n(90), F.lit("° C; "), n(7), F.lit(" mol % "))
    return table("orders").select("o_orderkey", t.grouping_text(text).alias("condition"))


@query("step_numbers", "SELECT p_partkey, p_size AS step, p_size AS plain, NULL::INTEGER AS none FROM part")
def step_numbers(spark, table):
    n = F.col("p_size").cast("string")
    return table("part").select("p_partkey", t.step_number(F.concat(F.lit(" Step "), n)).alias("step"), t.step_number(n).alias("plain"), t.step_number(F.concat(n, F.lit("a"))).alias("none"))


@query("paper_keys", r"SELECT page_id, lower(regexp_replace(regexp_extract(url, '[^/\\]*$'), '\.[^.]*$', '')) AS paper_key FROM pages")
def paper_keys(spark, table):
    return table("pages").select("page_id", t.paper_key(F.col("url")).alias("paper_key"))


@query("page_numbers", "SELECT o_orderkey, list_sort(list_distinct([o_custkey % 50 + 1, o_orderkey % 30 + 1]))::INTEGER[] AS pages FROM orders")
def page_numbers(spark, table):
    text = F.concat(F.lit("page "), (F.col("o_custkey") % 50 + 1).cast("string"), F.lit(", p. "), (F.col("o_orderkey") % 30 + 1).cast("string"), F.lit(" and 0"))
    return table("orders").select("o_orderkey", t.page_numbers(text).alias("pages"))


@query("safe_stems", "SELECT c_custkey, left(regexp_replace(lower(c_name), '[^a-z0-9]+', '_', 'g'), 50) || '_' || left(md5(c_name), 8) AS stem FROM customer")
def safe_stems(spark, table):
    return table("customer").select("c_custkey", t.safe_stem(F.col("c_name")).alias("stem"))


@query("effective_roles", "SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'catalyst' WHEN role = 'system' THEN 'light' ELSE 'assistant' END AS role FROM conversations")
def effective_roles(spark, table):
    role = F.col("role")
    refined = F.when(role == "user", "Precatalyst").when(role == "system", "light_source").otherwise("unknown")
    return table("conversations").select("conv_id", "turn", t.direct_role(t.effective_role(refined, role)).alias("role"))


@query(
    "reason_labelled_filter",
    """SELECT o_orderkey, CASE WHEN n IS NULL THEN 'empty_side' WHEN n_part = 0 THEN 'no_names' WHEN lo = hi AND n_part = 1 THEN 'same_names' WHEN bad THEN 'invalid_name' WHEN NOT good THEN 'target' END AS reason
       FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_linenumber > 1) AS n_part, count(DISTINCT l_returnflag) AS lo, count(DISTINCT l_linestatus) AS hi, bool_or(l_linenumber > 6) AS bad, bool_or(l_quantity >= 25) AS good FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
)
def reason_labelled_filter(spark, table):
    """Orders as reactions: the reason of each is the first rule that fails, as in filters.label_reactions()."""
    line = table("lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("n"), F.count_if(F.col("l_linenumber") > 1).alias("n_part"), F.count_distinct("l_returnflag").alias("lo"), F.count_distinct("l_linestatus").alias("hi"),
        F.bool_or(F.col("l_linenumber") > 6).alias("bad"), F.bool_or(F.col("l_quantity") >= 25).alias("good"),
    )
    named = lambda n: F.concat(F.lit("flag "), n.cast("string"))
    left = F.when(F.col("n").isNotNull(), F.when(F.col("n_part") > 0, F.array(F.when(F.col("bad") & ~((F.col("n_part") == 1) & (F.col("lo") == F.col("hi"))), "Product").otherwise(named(F.col("lo"))))).otherwise(F.array(F.lit(""))))
    right = F.when(F.col("n").isNotNull(), F.array(F.when(F.col("n_part") == 1, named(F.col("hi"))).otherwise("other")))
    passes = m.target_passes(F.when(F.col("good"), "80%").otherwise("trace"), F.lit(None).cast("string"), F.lit("high"), F.lit("high dr"))
    labelled = table("orders").join(line, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return labelled.select("o_orderkey", F.coalesce(filters.basic_reason(left, right), F.when(~passes, "target")).alias("reason"))


@query(
    "filter_statistics",
    """SELECT o_orderpriority, count(*) AS input, count(*) FILTER (o_totalprice < 100000) AS basic_failed, count(*) FILTER (o_totalprice >= 100000 AND o_orderstatus = 'F') AS target_failed,
       count(*) FILTER (o_totalprice >= 100000 AND o_orderstatus <> 'F') AS retained FROM orders GROUP BY o_orderpriority""",
)
def filter_statistics(spark, table):
    reason = F.when(F.col("o_totalprice") < 100000, "no_names").when(F.col("o_orderstatus") == "F", "target")
    return filters.filter_stats(table("orders").withColumn("reason", reason), "o_orderpriority")


@query("modality_names", "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'text' WHEN 1 THEN 'image' WHEN 2 THEN 'image' END AS modality FROM part")
def modality_names(spark, table):
    raw = F.element_at(F.array(*[F.lit(x) for x in (" Textual", "VISION ", "chemeagle", "sound")]), F.col("p_size") % 4 + 1)
    return table("part").select("p_partkey", filters.modality(raw).alias("modality"))


@query(
    "formula_hits",
    r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1)::INTEGER AS line_no FROM documents),
       h AS (SELECT doc_id, line_no, 'ether_gap' AS pattern, unnest(regexp_extract_all(line, '(?i)\bEt\s+O\b')) AS match FROM l
       UNION ALL SELECT doc_id, line_no, 'alkali_sulfate_gap', unnest(regexp_extract_all(line, '(?i)\b(?:Na|K|Li)\s+SO\b')) FROM l
       UNION ALL SELECT doc_id, line_no, 'alkali_carbonate_gap', unnest(regexp_extract_all(line, '(?i)\b(?:Na|K|Li)\s+CO\b')) FROM l
       UNION ALL SELECT doc_id, line_no, 'chlorinated_solvent_gap', unnest(regexp_extract_all(line, '(?i)\b(?:CH|CD)\s+Cl\b')) FROM l)
       SELECT * FROM h""",
)
def formula_hits(spark, table):
    return filters.broken_formulas(table("documents"), "doc_id")


@query("formula_candidates", None)
def formula_candidates(spark, table):
    return table("documents").select("doc_id", t.formula_candidates(F.col("text")).alias("formulas"))


@query("json_props", "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, lower(event_type) AS kind FROM events")
def json_props(spark, table):
    v = F.try_parse_json("props")
    return table("events").select("event_id", F.try_variant_get(v, "$.k", "long").alias("k"), F.lower("event_type").alias("kind"))


@query("join_pages", "SELECT conv_id, string_agg(replace(text, chr(10), ' '), ' ' ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def join_pages(spark, table):
    flat = F.regexp_replace("text", r"\n", " ")
    pages = F.transform(F.array_sort(F.collect_list(F.struct("turn", flat.alias("text")))), lambda x: x["text"])
    return table("conversations").groupBy("conv_id").agg(t.join_pages(pages).alias("text"))
