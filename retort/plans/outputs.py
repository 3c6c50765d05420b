"""Answers judged, outputs that grow, sets and matrices over the driver's tables, each query beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from retort import schemas
from retort.operators import molecules, validation
from retort.plans.base import dealt, query
from retort.storage import fresh_path
from retort.streaming import partial


def _reactions(text):
    return F.from_json(text, f"array<{schemas.REACTION}>")


@query(
    "retry_reasons",
    """
    SELECT c_custkey,
      CASE WHEN c_custkey % 3 = 1 THEN c_name || ': S' END AS foreign_source,
      CASE WHEN c_custkey % 4 = 0 AND c_custkey % 5 <> 0 THEN c_name || '; <missing id>' END AS no_substrate,
      CASE WHEN c_custkey % 3 <> 2 THEN CASE WHEN c_custkey % 3 = 0 THEN c_name || ': ' || CASE WHEN c_custkey % 4 = 0 THEN 'substrates, ' ELSE '' END || 'catalysts, conditions.time, reaction_type, step_count'
        ELSE c_name || ': ' || CASE WHEN c_custkey % 4 = 0 THEN 'substrates, ' ELSE '' END || 'catalysts, conditions.time, reaction_type, step_count' END END AS lacking
    FROM customer
    """,
)
def retry_reasons(spark, table):
    """What answers lack that name a given procedure, another one or none."""
    k, name = F.col("c_custkey"), F.col("c_name")
    source = F.when(k % 3 == 0, "G").when(k % 3 == 1, "S")
    compound = lambda n: F.array(F.struct(n.alias("name")))
    outcome = F.struct(F.when(k % 5 != 0, "9%").otherwise(" \n").alias("yield"))
    solvent = F.create_map(F.lit("solvent"), F.array(F.struct(F.lit("THF").alias("value"))))
    one = F.struct(name.alias("id"), source.alias("gp_source"), compound(F.when(k % 4 != 0, name).otherwise(" ")).alias("substrates"), compound(name).alias("products"), outcome.alias("targets"), solvent.alias("conditions"))
    nameless = F.struct(F.lit(" ").alias("id"), F.lit(None).cast("string").alias("gp_source"), compound(F.when(k % 4 != 0, name)).alias("substrates"), compound(name).alias("products"), outcome.alias("targets"), solvent.alias("conditions"))
    template = F.struct(compound(F.lit("s")).alias("substrates"), compound(F.lit("Pd")).alias("catalysts"), compound(F.lit(" \t")).alias("ligands"), F.lit("coupling").alias("reaction_type"), F.lit(2).alias("step_count"), F.create_map(F.lit("time"), F.array(F.struct(F.lit("1 h").alias("value"))), F.lit("solvent"), F.array(F.struct(F.lit("DMF").alias("value")))).alias("conditions"))
    entry = F.struct(F.lit("valid").alias("status"), F.from_json(F.to_json(template), schemas.REACTION).alias("template"))
    rows = dealt(table("customer")).select("c_custkey", _reactions(F.to_json(F.array(one, nameless))).alias("r"), F.create_map(F.lit("G"), entry).alias("t"))
    r, mode, keys = F.col("r"), F.lit("mixed"), F.array(F.lit("G"))
    shown = lambda c: F.nullif(validation.preview(c, 5), F.lit(""))
    return rows.select("c_custkey", shown(validation.foreign_templates(r, mode, keys)).alias("foreign_source"), shown(validation.empty_substrates(r, mode, keys)).alias("no_substrate"), shown(validation.missing_template_fields(r, mode, keys, F.col("t"))).alias("lacking"))


_N = 7  # atoms of a matrix, filled row by row from the first numbers of an embedding


@query(
    "atom_bonds",
    f"""
    WITH RECURSIVE e AS (SELECT vec_id, i, j, floor(abs(embedding[i * {_N} + j + 1]::DOUBLE) * 997)::INT % 23 AS x FROM embeddings, range({_N}) a(i), range({_N}) b(j) WHERE i < j),
    b AS (SELECT vec_id, i, j, ['single', 'double', 'triple', 'aromatic', 'solid wedge', 'dashed wedge'][x] AS kind FROM e WHERE x BETWEEN 1 AND 6),
    n AS (SELECT vec_id, i AS v, j AS w FROM b UNION ALL SELECT vec_id, j, i FROM b),
    r AS (SELECT vec_id, i AS v, i AS w FROM embeddings, range({_N}) a(i) UNION SELECT r.vec_id, r.v, n.w FROM r JOIN n ON r.vec_id = n.vec_id AND r.w = n.v),
    f AS (SELECT vec_id, count(DISTINCT m) AS fragments, string_agg(m::VARCHAR, ',' ORDER BY v) AS labels FROM (SELECT vec_id, v, min(w) AS m FROM r GROUP BY ALL) GROUP BY vec_id)
    SELECT vec_id, fragments, labels, coalesce(bonds, '') AS bonds FROM f LEFT JOIN (SELECT vec_id, string_agg(i || '-' || j || ' ' || kind, ',' ORDER BY i, j) AS bonds FROM b GROUP BY vec_id) USING (vec_id)
    """,
)
def atom_bonds(spark, table):
    """Bonds and fragments of molecules whose matrices are made of embeddings; cells below the diagonal count nowhere."""
    cell = lambda i, j: F.floor(F.abs(F.get("embedding", F.lit(i * _N + j)).cast("double")) * 997).cast("int") % 23
    edges = F.array(*[F.array(*[cell(i, j) for j in range(_N)]) for i in range(_N)])
    rows = table("embeddings").select("vec_id", molecules.bonds(F.lit(_N), edges).alias("b"))
    found = rows.withColumn("f", molecules.fragments(F.lit(_N), F.col("b")))
    shown = F.array_join(F.transform("b", lambda x: F.concat(x["i"].cast("string"), F.lit("-"), x["j"].cast("string"), F.lit(" "), x["bond_type"])), ",")
    return found.select("vec_id", F.size(F.array_distinct("f")).cast("long").alias("fragments"), F.array_join(F.col("f").cast("array<string>"), ",").alias("labels"), shown.alias("bonds"))


@query(
    "contained_orders",
    """
    WITH s AS (SELECT l_orderkey AS k, list_sort(list(DISTINCT l_partkey % 97)) AS items FROM lineitem GROUP BY 1),
    d AS (SELECT DISTINCT items, array_to_string(items, ',') AS id, len(items) AS n FROM s),
    p AS (SELECT id, n, unnest(items) AS item FROM d),
    c AS (SELECT a.id AS small, b.id AS large FROM p a JOIN p b ON a.item = b.item AND b.n > a.n GROUP BY a.id, b.id, a.n HAVING count(*) = a.n)
    SELECT s.k AS l_orderkey, (SELECT count(*) FROM c WHERE small = array_to_string(s.items, ',')) AS held_by FROM s
    """,
)
def contained_orders(spark, table):
    """For each order, in how many different, larger sets of kinds of parts its own lies."""
    return validation.held_by(table("lineitem").select("l_orderkey", (F.col("l_partkey") % 97).alias("kind")), "l_orderkey", "kind")


@query(
    "leaked_names",
    "SELECT p_partkey AS question_id, lower(p_brand) AS answer FROM part WHERE p_size % 3 = 0 UNION ALL SELECT p_partkey, split_part(p_name, ' ', 2) FROM part WHERE p_size % 2 = 0 AND contains(' ' || lower(p_name) || ' ', ' ' || split_part(lower(p_name), ' ', 2) || ' ') AND split_part(p_name, ' ', 2) <> ''",
)
def leaked_names(spark, table):
    """Questions about parts whose text gives a gold answer away: whole words only, in any case."""
    k = F.col("p_size")
    text = F.concat(F.lit("Which of these? "), F.when(k % 2 == 0, F.upper("p_name")).otherwise("none"), F.when(k % 3 == 0, F.concat(F.lit(" ("), F.upper("p_brand"), F.lit(")"))).otherwise(""))
    rows = table("part").select(F.col("p_partkey").alias("question_id"), text.alias("question_text"))
    brand, word = F.lower("p_brand"), F.coalesce(F.get(F.split("p_name", " "), F.lit(1)), F.lit(""))
    answers = table("part").select(F.col("p_partkey").alias("question_id"), F.explode(F.array(brand, word)).alias("answer"))
    return validation.leaked_questions(rows, answers)


@query("partial_events", "SELECT event_type, count(*) AS n, sum(value * 100)::BIGINT AS cents, false AS is_partial FROM (SELECT event_type, round(value, 2) AS value FROM events) GROUP BY event_type")
def partial_events(spark, table):
    """Events stored batch by batch from a stream of their files, and read once the output is whole."""
    source, path = table("events"), fresh_path(spark)
    folder, name = source.inputFiles()[0].rsplit("/", 1)  # a table is a folder of files or one file among others
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "*.parquet" if folder.endswith(".parquet") else name).parquet(folder)
    partial.run_resumable(stream, lambda rows: rows.select("event_type", F.round("value", 2).alias("value")), path, f"{path}/checkpoint")
    rows, more = partial.read_partial(spark, path)
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum(F.col("value") * 100)).cast("long").alias("cents")).withColumn("is_partial", F.lit(more))


@query("rewritten_samples", "SELECT user_id % 4 AS gpu_index, count(*) FILTER (event_type <> 'click') AS samples, count(*) FILTER (event_type = 'click') AS errors, max(event_id) AS peak_memory FROM events GROUP BY 1")
def rewritten_samples(spark, table):
    """Samples appended in four parts, each day then rewritten in the order of time, and summed up for each unit."""
    path, e = fresh_path(spark), table("events")
    rows = e.select(F.col("ts").alias("created_at"), (F.col("user_id") % 4).alias("gpu_index"), F.col("event_id").alias("memory_used"), F.col("value").alias("utilization"), F.col("value").alias("elapsed_seconds"), F.when(F.col("event_type") == "click", "timeout").alias("error"))
    for part in range(4):
        partial.append_samples(rows.filter(F.pmod(F.xxhash64("memory_used"), F.lit(4)) == part), path)
    partial.rewrite_samples(spark, path)
    return partial.summarize_samples(spark.read.parquet(path)).select("gpu_index", "samples", "errors", "peak_memory")
