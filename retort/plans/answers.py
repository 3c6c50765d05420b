"""Roles answered by a provider and keys of procedures' titles over the driver's tables, each query beside its SQL."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from retort import extraction
from retort.functions import vocab
from retort.operators import procedures
from retort.plans.base import query


class Roles:
    """Answers by the texts of conditions. Fails for a batch of record Brand#3, leaves out every fifth reaction of a batch,
    and gives unclear texts a role that isn't known."""

    def answer(self, keys: list[str]) -> list[str | None]:
        return [self._one(json.loads(k)) for k in keys]

    def _one(self, request: dict) -> str:
        reactions = request["reactions"]
        if len(reactions) > 1 and request["record"] == "Brand#3":
            raise ValueError("batch refused")
        told = [r for r in reactions if len(reactions) == 1 or r["reaction_index"] % 5]
        role = {"water": "Solvent", "unclear": "mystery"}
        rows = [{"reaction_index": r["reaction_index"], "conditions": [{"condition_index": c["condition_index"], "refined_role": role.get(c["text"], "base"), "reason": "text"} for c in r["conditions"]]} for r in told]
        return json.dumps({"reactions": rows})


_CONDITIONS = """c AS (SELECT p_brand AS record_id, p_partkey AS reaction_pos, k AS condition_pos, CASE k WHEN 0 THEN 'light source' WHEN 1 THEN CASE WHEN p_size % 2 = 0 THEN 'unknown' ELSE 'agent' END ELSE 'thing' END AS original_role,
  CASE WHEN k = 1 AND p_size % 7 = 0 THEN 'unclear' WHEN k = 2 AND p_size % 3 = 0 THEN 'water' ELSE p_type END AS text FROM part, unnest([0, 1, 2]) AS x(k)),
r AS (SELECT *, CASE WHEN condition_pos = 0 THEN 'light' WHEN text = 'unclear' THEN CASE original_role WHEN 'unknown' THEN 'unknown' ELSE 'reagent' END WHEN text = 'water' THEN 'solvent' ELSE 'base' END AS refined_role,
  CASE WHEN condition_pos = 0 THEN 'original' WHEN text = 'unclear' THEN 'fallback' ELSE 'refined' END AS role_source FROM c)"""


def _refined(table):
    k = F.col("k")
    text = F.when((k == 1) & (F.col("p_size") % 7 == 0), "unclear").when((k == 2) & (F.col("p_size") % 3 == 0), "water").otherwise(F.col("p_type"))
    role = F.when(k == 0, "Light_Source").when(k == 1, F.when(F.col("p_size") % 2 == 0, "Unknown").otherwise("agent")).otherwise("thing")
    rows = table("part").withColumn("k", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    rows = rows.select(F.col("p_brand").alias("record_id"), F.col("p_partkey").cast("int").alias("reaction_pos"), k.alias("condition_pos"), role.alias("role"), text.alias("text"))
    return extraction.refine_roles(rows, Roles())


@query("refined_roles", f"WITH {_CONDITIONS} SELECT record_id, reaction_pos, condition_pos, original_role, refined_role, role_source FROM r")
def refined_roles(spark, table):
    return _refined(table).select("record_id", "reaction_pos", "condition_pos", "original_role", "refined_role", "role_source")


@query("refined_role_counts", f"WITH {_CONDITIONS} SELECT record_id, count(*) AS conditions, count(*) FILTER (role_source = 'original') AS original, count(*) FILTER (role_source = 'refined') AS refined, count(*) FILTER (role_source = 'fallback') AS fallback FROM r GROUP BY ROLLUP (record_id)")
def refined_role_counts(spark, table):
    return extraction.role_counts(_refined(table))


@query(
    "procedure_keys",
    """
    WITH k AS (SELECT p_brand AS brand, p_partkey, CASE p_partkey % 9
      WHEN 0 THEN 'GP-' || p_size WHEN 1 THEN 'GeneralProcedure' || p_size WHEN 2 THEN 'GeneralProcedure_' || p_size || 'a-' || p_size || 'f-' || p_size
      WHEN 3 THEN 'GeneralProcedure' || p_size WHEN 4 THEN 'GeneralProcedure_coupling_of_' || replace(p_name, ' ', '_') WHEN 5 THEN 'GeneralProcedure_' || replace(p_name, ' ', '_') || '_of_type_' || lower(p_type)
      WHEN 6 THEN 'GeneralProcedureB' WHEN 7 THEN 'GeneralProcedure' || p_size END AS gp_key FROM part)
    SELECT p_partkey, coalesce(gp_key, 'GeneralProcedureUnlabeled' || row_number() OVER (PARTITION BY brand, gp_key IS NULL ORDER BY p_partkey)) AS gp_key FROM k
    """,
)
def procedure_keys(spark, table):
    """Keys of titles of every form: labelled, of products, of words of their own or of the text after, and of none."""
    k, n, name = F.col("p_partkey") % 9, F.col("p_size").cast("string"), F.col("p_name")
    title = (
        F.when(k == 0, F.concat(F.lit("2. GP –"), n, F.lit(". Amination")))
        .when(k == 1, F.concat(F.lit("Typical  procedure "), n, F.lit(" (1 mmol): ")))
        .when(k == 2, F.concat(F.lit("General procedure for synthesis of "), n, F.lit("a – "), n, F.lit("f and "), n))
        .when(k == 3, F.concat(F.lit("See the procedure "), n, F.lit(" - short")))
        .when(k == 4, F.concat(F.lit("Representative procedure for the coupling of "), name, F.lit(": under argon")))
        .when(k == 5, F.lit("General procedure"))
        .when(k == 6, F.lit("1) standard conditions b："))
        .when(k == 7, F.concat(F.lit("Experimental Procedure "), n, F.lit(":")))
        .otherwise("Procedure")
    )
    after = F.when(k == 5, F.concat(F.lit("--- Page 3 --- The "), name, F.lit(" of type "), F.col("p_type"), F.lit(" in a flask: heated")))
    rows = table("part").select("p_partkey", "p_brand", title.alias("title"), after.alias("after"))
    return procedures.keyed_titles(rows, ["p_brand"], "p_partkey", "after").select("p_partkey", "gp_key")


def _listed(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


@query(
    "procedure_cues",
    f"""
    WITH w AS (SELECT {_listed(vocab.PROCEDURE_DEFINITIONS)} AS does, {_listed(vocab.PROCEDURE_REFERENCES)} AS refers),
    p AS (SELECT p_partkey, does[1 + p_partkey % 17] AS work, w.refers, rpad(repeat('x', CASE p_size % 4 WHEN 0 THEN 95 ELSE 20 END) || ' ' || CASE WHEN p_partkey % 3 = 0 THEN w.refers[1 + p_partkey % 8] ELSE '' END, 120, 'y') AS head, CASE p_size % 4 WHEN 1 THEN 175 ELSE 3 END AS gap FROM part, w)
    SELECT p_partkey, 121 + gap + length(work) <= 300 AND len([r FOR r IN refers IF contains(head[:100], r)]) = 0 AS told, p_partkey % 2 = 0 AS named, p_partkey % 2 = 0 AS refers, p_partkey % 4 = 0 AS refers_to_some FROM p
    """,
)
def procedure_cues(spark, table):
    """Whether titles head a procedure: every word of work and of reference, near and too far; and what refers to them."""
    pick = lambda words: F.element_at(F.array(*[F.lit(w) for w in words]), (F.col("p_partkey") % len(words) + 1).cast("int"))
    refers = F.when(F.col("p_partkey") % 3 == 0, pick(vocab.PROCEDURE_REFERENCES)).otherwise("")
    head = F.rpad(F.concat(F.repeat(F.lit("x"), F.when(F.col("p_size") % 4 == 0, 95).otherwise(20)), F.lit(" "), refers), 120, "y")
    after = F.concat(head, F.repeat(F.lit("z"), F.when(F.col("p_size") % 4 == 1, 175).otherwise(3)), F.lit(" "), F.upper(pick(vocab.PROCEDURE_DEFINITIONS)))
    even, fourth = F.col("p_partkey") % 2 == 0, F.col("p_partkey") % 4 == 0
    before = F.concat(F.col("p_name"), F.when(even, F.lit(" was made according\n--- Page 7 ---\n to  ")).otherwise(F.lit(" was made. ")))
    text = F.when(fourth, "made following the general procedure, with care").when(even, "made following general procedure B").otherwise(F.col("p_name"))
    return table("part").select("p_partkey", procedures.told_after(after).alias("told"), procedures.named_before(before).alias("named"), procedures.refers_to_gp(text).alias("refers"), procedures.refers_to_some_gp(text).alias("refers_to_some"))
