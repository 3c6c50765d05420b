"""Whole runs without model calls: merge, backfill, graph, summary and questions, from payloads to tables.

Each stage ends in a table: a plan that held several would repeat its nested expressions in each other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retort import schemas
from retort.functions import metrics as m
from retort.functions.vocab import EDGE_COLUMNS
from retort.operators import canon, dedupe, filters, graph, questions, reports, resolve, validation
from retort.sources import payloads
from retort.storage import materialize


@dataclass(frozen=True)
class Policies:
    """The choices that change results."""

    substrate_name: str = "resolved"  # resolved, original_if_available, registry_if_resolved_else_original
    reaction_type: str = "required"  # required, ignored
    objectives: tuple[str, ...] = (m.COMBINED, m.YIELD_ONLY)
    product_names: str = "described"  # or any: whether a product's name has to tell what it is
    q1_condition: str = "any_visible_structured_condition_v1"  # or legacy_conditions_only


def load(spark: SparkSession, text_dir: str, image_dir: str | None = None) -> DataFrame:
    """The reactions of a folder of text payloads and, if given, one of image payloads."""
    text = payloads.reactions_of(payloads.read_payloads(spark, text_dir)).withColumn("source_image", F.lit(""))
    return materialize(text if image_dir is None else text.unionByName(payloads.image_reactions_of(payloads.read_image_payloads(spark, image_dir))))


def merge(reactions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reactions that pass the filter, outcomes cleaned and excesses derived from ratios; counts of conversion statuses)."""
    kept = filters.kept(filters.label_reactions(reactions))
    none = F.lit(None).cast("string")
    top = F.struct(*[none.alias(k) for k in ("yield", "ee", "er", "dr")])
    targets, status = canon.derive_ee(canon.lift_targets(F.col("reaction.targets"), top))
    out = materialize(kept.withColumn("conversion", status).withColumn("reaction", F.col("reaction").withField("targets", targets)))
    return out.drop("conversion"), reports.distribution(out.filter("conversion is not null"), "conversion")


def dedupe_reactions(reactions: DataFrame) -> DataFrame:
    """One row for each content (conditions aside) of a paper and modality, the first by the order key; pages are united,
    ids renumbered by procedure, and the old id kept as original_id."""
    r = F.col("reaction")
    signed = reactions.withColumn("signature", dedupe.signature(r["substrates"], r["products"], r["intermediates"], r["step_count"], r["targets"])).withColumn("pages", F.coalesce(r["source_pages"], F.array().cast("array<int>")))
    scope = ["source_paper", "source_modality", "signature"]
    order = ["file_pos", "reaction_pos"]
    kept = dedupe.dedupe_union(signed, scope, order, [*order, "paper_key", "source_image", "reaction"], "pages")
    kept = kept.withColumn("reaction", F.col("reaction").withField("source_pages", F.col("pages"))).withColumn("prefix", F.coalesce("reaction.gp_source", F.lit("NonGP"))).withColumn("id", F.col("reaction.id"))
    out = dedupe.renumber(kept, ["source_paper", "source_modality", "prefix"], order, F.col("prefix"))
    return materialize(out.withColumn("reaction", F.col("reaction").withField("id", F.col("id"))).drop("signature", "pages", "prefix", "id"))


def backfill(reactions: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reactions with compounds named by the registry, statuses by paper). Outcomes don't change; see unchanged()."""
    numbered = payloads.explode_compounds(reactions)
    aligned = materialize(resolve.align_registry(numbered, registry))
    renamed = F.col("compound").withField("original_name", F.coalesce("compound.original_name", "compound.name")).withField("name", F.col("name")).withField("registry_name", F.col("found")).withField("registry_match_status", F.col("status")).withField("resolution_source", F.when(F.col("status") == "resolved", "name_registry").otherwise(F.col("compound.resolution_source")))
    named = aligned.withColumn("compound", F.when(F.col("status") == "none", F.col("compound")).otherwise(renamed))
    listed = named.groupBy(*schemas.ORDER_KEY).agg(F.array_sort(F.collect_list(F.struct("field", "item_pos", "compound")), lambda a, b: F.when(a["field"] < b["field"], -1).when(a["field"] > b["field"], 1).otherwise(a["item_pos"] - b["item_pos"])).alias("_all"))
    out, body = reactions.join(listed, list(schemas.ORDER_KEY), "left"), F.col("reaction")
    of = lambda role: F.coalesce(F.transform(F.filter("_all", lambda x: x["field"] == role), lambda x: x["compound"]), F.col(f"reaction.{role}"))
    for role in schemas.ROLES:
        body = body.withField(role, of(role))
    return materialize(out.withColumn("reaction", body).drop("_all")), aligned.groupBy("source_paper", "status").agg(F.count("*").alias("n"))


def unchanged(before: DataFrame, after: DataFrame) -> bool:
    """Whether a backfill has left every outcome as it was."""
    flat = lambda df: df.select(*schemas.ORDER_KEY, "reaction.id", "reaction.targets.*")
    return validation.changed_outcomes(flat(before), flat(after), *flat(before).columns).isEmpty()


def build_graph(reactions: DataFrame, policies: Policies = Policies()) -> tuple[DataFrame, DataFrame]:  # noqa: B008
    """(edges of text, images and strong alignments, distinct; all alignments)."""
    text, image = reactions.filter("source_modality = 'text'"), reactions.filter("source_modality = 'image'")
    entities = {k: materialize(graph.mentions(payloads.explode_compounds(df), k)) for k, df in (("text", text), ("image", image))}
    aligned = materialize(graph.align(entities["text"], entities["image"]))
    a, b = (entities[k].select(F.col("entity_id").alias(f"{k}_id"), F.col("name").alias(f"{k}_name"), F.col("source_paper").alias(f"{k}_paper")) for k in ("text", "image"))
    named = aligned.join(a, "text_id").join(b, "image_id").withColumn("pdf_name", F.col("text_paper"))
    return materialize(graph.unify(graph.text_edges(text, policies.substrate_name), graph.image_edges(image), graph.alignment_edges(named))), aligned


def summarize(edges: DataFrame) -> DataFrame:
    """Edges as one row for each reaction, in the edges' own order."""
    return graph.fold_edges(edges.withColumn("pos", F.struct(*EDGE_COLUMNS)))


def split(reactions: DataFrame, policies: Policies = Policies()) -> DataFrame:  # noqa: B008
    """reactions with in_q1 and in_q2: the first needs a condition that shows, the second a valid one and a known scaffold."""
    r = F.col("reaction")
    legacy = filters.has_valid_condition(F.coalesce(r["conditions"], F.expr(f"cast(map() as {schemas.CONDITIONS})")))
    q1 = legacy if policies.q1_condition == "legacy_conditions_only" else questions.has_visible_condition(r)
    return reactions.withColumns({"in_q1": q1, "in_q2": legacy & (F.size(questions.scaffold_key(r["substrates"])) > 0)})


def question_packages(reactions: DataFrame, policies: Policies = Policies()) -> dict[tuple[str, str, str], tuple[DataFrame, DataFrame]]:  # noqa: B008
    """(questions with ids, review) by task (Q1, Q2), modality and objective."""
    parted = materialize(split(reactions, policies))
    out = {}
    for modality in ("text", "image"):
        mine = parted.filter(F.col("source_modality") == modality)
        for objective in policies.objectives:
            label = "COMBINED" if objective == m.COMBINED else "YIELD"
            for task, make, group in (("Q1", questions.condition_questions, ("source_paper", "reaction_type", "substrates", "products")), ("Q2", questions.substrate_questions, ("source_paper", "reaction_type", "scaffolds", "condition", "variable"))):
                names = {"product_names": policies.product_names} if task == "Q1" else {}
                found, review = make(mine.filter(F.col(f"in_{task.lower()}")), objective, policies.reaction_type, **names)
                out[task, modality, objective] = questions.numbered(found, group, f"{task}_{label}_{modality.upper()}"), review
    return out
