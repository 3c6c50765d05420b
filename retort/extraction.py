"""Extraction by a provider in rounds: a screen that fails open, feedback on what an answer lacks, and an audit of what was left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retort import schemas
from retort.functions import text as t
from retort.functions import vocab
from retort.operators.validation import empty_substrates, foreign_templates, missed_targets, missing_template_fields, preview
from retort.providers import Provider, ask, repair_json
from retort.sources.payloads import reactions_of
from retort.storage import materialize

_ATTEMPT = "struct<attempt:int,kind:string,message:string>"
FAILED = "failed_after_retries"


def parse_answers(answers: DataFrame, key: str, answer: str = "answer") -> DataFrame:
    """answers with `reactions`: those of a JSON list, of an object's `missing_reactions` or else `reactions`, in their order;
    null if the text is none of these. Code fences, text around the JSON and a missing end don't matter. Keys are unique."""
    v, kind = F.col("_v"), F.schema_of_variant("_v")
    inside = lambda name: F.try_variant_get(v, f"$.{name}", "array<variant>")
    listed = F.when(kind.startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")).when(kind.startswith("OBJECT"), F.coalesce(inside("missing_reactions"), inside("reactions")))
    read = materialize(answers.withColumn("_v", F.try_parse_json(repair_json(t.strip_fence(F.col(answer))))).withColumn("_l", F.to_json(listed)).drop("_v"))
    payload = F.parse_json(F.concat(F.lit('{"reactions":'), F.col("_l"), F.lit("}")))
    rows = reactions_of(read.filter("_l is not null").select(F.col(key).cast("string").alias("file"), payload.alias("payload")))
    placed = F.array_sort(F.collect_list(F.struct("reaction_pos", "reaction")), lambda a, b: a["reaction_pos"] - b["reaction_pos"])
    found = rows.groupBy(F.col("file_pos").alias("_k")).agg(F.transform(placed, lambda x: x["reaction"]).alias("_r"))
    none = F.expr(f"cast(array() as array<{schemas.REACTION}>)")
    out = read.join(found, read[key].cast("string") == F.col("_k"), "left")
    return out.select(*answers.columns, F.when(F.col("_l").isNotNull(), F.coalesce("_r", none)).alias("reactions"))


def screen(chunks: DataFrame, provider: Provider, key: str = "chunk_id", text: str = "text") -> DataFrame:
    """chunks with has_reactions, relevant_pages and screen_error. A chunk whose answer fails or isn't an object with a yes
    or no is kept whole: nothing is lost to a screen that errs."""
    answers = ask(chunks.select(F.coalesce(text, F.lit("")).alias("key")), provider)
    v = F.try_parse_json(repair_json(t.strip_fence(F.col("answer"))))
    read = answers.select(F.col("key").alias("_key"), F.try_variant_get(v, "$.has_reactions", "boolean").alias("_has"), F.try_variant_get(v, "$.relevant_pages", "array<int>").alias("_pages"))
    out = chunks.join(read, F.coalesce(text, F.lit("")) == F.col("_key"), "left")
    none, failed = F.expr("cast(array() as array<int>)"), F.col("_has").isNull()
    return out.select(*chunks.columns, F.coalesce("_has", F.lit(True)).alias("has_reactions"), F.when(failed, none).otherwise(F.coalesce("_pages", none)).alias("relevant_pages"), failed.alias("screen_error"))


def detectors(templates: Column) -> dict[str, Column]:
    """What an answer lacks, by the kind of a retry: columns reactions, mode, gp_keys and text of a job, and its templates."""
    r, mode, keys = F.col("reactions"), F.col("mode"), F.col("gp_keys")
    return {
        "MissingTemplateFields": missing_template_fields(r, mode, keys, templates),
        "EmptySubstrates": empty_substrates(r, mode, keys),
        "ForeignTemplate": foreign_templates(r, mode, keys),
        "MissingTargets": missed_targets(F.col("text"), mode, r),
    }


def extract(jobs: DataFrame, provider: Provider, templates: DataFrame | None = None, tries: int = 3, batch: int = 32) -> DataFrame:
    """job_id, reactions, error and attempts of each job (job_id unique, mode, gp_keys, text, prompt).

    Only jobs whose answer failed go round again, with what was wrong added to their prompt, `tries` times at most; what
    lacks something in the last round is taken as it is, as is anything from a job without a template. An empty answer
    keeps the feedback of the round before. Each round is a stored table, so a lost executor repeats no request of an
    earlier round; equal requests of a round are sent once. Null prompts and texts are empty ones, and an empty table
    gives an empty one. templates: gp_key, status, template (schemas.REACTION); a job gets those that its gp_keys name.
    """
    base = jobs.select("job_id", "mode", F.coalesce("gp_keys", F.expr("cast(array() as array<string>)")).alias("gp_keys"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("prompt", F.lit("")).alias("prompt"))
    body = f"map<string,struct<status:string,template:{schemas.REACTION}>>"
    if templates is None:
        base = base.withColumn("_templates", F.lit(None).cast(body))
    else:
        named = base.select("job_id", F.explode(F.array_distinct("gp_keys")).alias("gp_key")).join(templates.select("gp_key", F.struct("status", "template").alias("t")).dropDuplicates(["gp_key"]), "gp_key")
        base = base.join(named.groupBy("job_id").agg(F.map_from_entries(F.collect_list(F.struct("gp_key", "t"))).cast(body).alias("_templates")), "job_id", "left")
    carried = list(base.columns)
    frontier = materialize(base.withColumn("feedback", F.lit(None).cast("string")).withColumn("attempts", F.expr(f"cast(array() as array<{_ATTEMPT}>)")))
    done = []
    for n in range(1, tries + 1):
        asked = frontier.withColumn("_request", F.concat_ws("\n", "prompt", "feedback"))
        answers = ask(asked.select("_request"), provider, "_request", batch, tries=1).withColumnRenamed("key", "_request")
        read = parse_answers(asked.join(answers, "_request", "left").drop("_request"), "job_id")
        lacks = {k: preview(c, 8) for k, c in detectors(F.col("_templates")).items()}
        wrong = F.filter(F.array(*[F.when(m != "", F.struct(F.lit(k).alias("kind"), F.concat(F.lit(f"{k}: "), m).alias("message"))) for k, m in lacks.items()]), lambda x: x.isNotNull())
        judged = read.withColumn("_wrong", wrong if n < tries else F.slice(wrong, 1, 0))
        kind = (
            F.when(F.col("answer").isNull(), "RequestFailed")
            .when(t.strip(F.col("answer")) == "", "EmptyResponse")
            .when(F.col("reactions").isNull(), "SchemaError")
            .when(F.size("_wrong") > 1, "SeveralLacks")
            .when(F.size("_wrong") == 1, F.get("_wrong", F.lit(0))["kind"])
        )
        said = F.array_join(F.transform("_wrong", lambda x: x["message"]), "\n")
        message = F.when(kind == "SchemaError", "Previous output failed schema validation: not a list of reactions").when(F.size("_wrong") > 0, said)
        judged = materialize(judged.withColumn("_kind", kind).withColumn("_message", message).drop("_wrong"))
        done.append(judged.filter("_kind is null").select("job_id", "reactions", F.lit(None).cast("string").alias("error"), "attempts"))
        attempt = F.struct(F.lit(n).alias("attempt"), F.col("_kind").alias("kind"), F.col("_message").alias("message"))
        frontier = judged.filter("_kind is not null").select(*carried, F.coalesce("_message", "feedback").alias("feedback"), F.concat("attempts", F.array(attempt)).alias("attempts"))
        if frontier.isEmpty():
            break
    none = F.expr(f"cast(array() as array<{schemas.REACTION}>)")
    out = frontier.select("job_id", none.alias("reactions"), F.lit(FAILED).alias("error"), "attempts")
    for part in done:
        out = part.unionByName(out)
    return out


def audit(outcomes: DataFrame, jobs: DataFrame, provider: Provider, batch: int = 32) -> DataFrame:
    """outcomes with the reactions that a second look finds added at the end, and audit_recovered, their number.

    A reaction is one that is there already if its substrates, products and outcomes are alike. Jobs with an error aren't
    looked at, and an audit that fails adds nothing.
    """
    seen = F.to_json(F.transform("reactions", lambda r: F.struct(r["id"].alias("id"), F.transform(r["products"], lambda c: F.coalesce(c["name"], c["symbol"])).alias("products"))))
    request = F.concat_ws("\n", "prompt", F.lit("Give only reactions that this list lacks:"), seen)
    asked = materialize(outcomes.filter("error is null").join(jobs.select("job_id", "prompt"), "job_id").select("job_id", request.alias("_request")))
    answers = ask(asked.select("_request"), provider, "_request", batch, tries=1).withColumnRenamed("key", "_request")
    more = parse_answers(asked.join(answers, "_request").select("job_id", "answer"), "job_id").select("job_id", F.col("reactions").alias("_more"))
    names = lambda cs: F.array_sort(F.transform(cs, lambda c: F.lower(t.first_text(c["name"], c["symbol"]))))
    sign = lambda r: F.to_json(F.struct(names(r["substrates"]).alias("s"), names(r["products"]).alias("p"), r["targets"].alias("t")))
    known = F.transform("reactions", sign)
    # The first of several alike, and none that is there.
    fresh = F.filter(F.col("_more"), lambda r, i: ~F.array_contains(known, sign(r)) & (F.array_position(F.transform("_more", sign), sign(r)) == i + 1))
    out = outcomes.join(more, "job_id", "left").withColumn("_more", F.coalesce(fresh, F.expr(f"cast(array() as array<{schemas.REACTION}>)")))
    return out.select(*[F.concat("reactions", "_more").alias(c) if c == "reactions" else c for c in outcomes.columns], F.size("_more").alias("audit_recovered"))


_ROLES_ANSWER = "struct<reactions:array<struct<reaction_index:int,conditions:array<struct<condition_index:int,refined_role:string,reason:string>>>>>"
_AT = ["record_id", "reaction_pos", "condition_pos"]


def _roles_answered(pending: DataFrame, request: list[str], provider: Provider, batch: int) -> DataFrame:
    """pending with `answered` (role, reason; null if there is no valid one), by one request for each value of `request`.

    Of answers for a reaction the last counts, of those for a condition the first with a known role.
    """
    condition = F.struct(F.col("condition_pos").alias("condition_index"), "role", "text")
    reactions = pending.groupBy(*dict.fromkeys([*request, "record_id", "reaction_pos"])).agg(F.array_sort(F.collect_list(condition)).alias("conditions"))
    body = F.array_sort(F.collect_list(F.struct(F.col("reaction_pos").alias("reaction_index"), "conditions")))
    asked = materialize(reactions.groupBy(*request).agg(F.to_json(F.struct(F.first("record_id").alias("record"), body.alias("reactions"))).alias("_request")))
    answers = ask(asked.select("_request"), provider, "_request", batch, tries=1).withColumnRenamed("key", "_request")
    read = asked.join(answers, "_request").select(*request, F.from_json(repair_json(t.strip_fence(F.col("answer"))), _ROLES_ANSWER)["reactions"].alias("r"))
    each = read.select(*request, F.posexplode("r").alias("at", "r")).select(*request, "at", F.col("r.reaction_index").alias("_of"), F.col("r.conditions").alias("c"))
    last = each.groupBy(*request, "_of").agg(F.max(F.struct("at", "c"))["c"].alias("c"))
    rows = last.select(*request, "_of", F.posexplode("c").alias("at", "c"))
    role = F.replace(F.lower(t.clean_text(F.col("c.refined_role"))), F.lit("_"), F.lit(" "))
    known = rows.select(*request, "_of", F.col("c.condition_index").alias("_condition"), "at", role.alias("role"), F.coalesce(F.nullif(t.clean_text(F.col("c.reason")), F.lit("")), F.lit("answer without a reason")).alias("reason")).filter(F.col("role").isin(*vocab.REFINED_ROLES))
    first = known.groupBy(*request, "_of", "_condition").agg(F.min(F.struct("at", "role", "reason")).alias("_f"))
    first = first.select(*[F.col(c).alias(f"_{c}") for c in request], "_of", "_condition", F.struct("_f.role", "_f.reason").alias("answered"))
    met = (pending["reaction_pos"] == first["_of"]) & (pending["condition_pos"] == first["_condition"])
    for c in request:
        met = met & (pending[c] == first[f"_{c}"])
    return pending.join(first, met, "left").select(*pending.columns, "answered")


def refine_roles(conditions: DataFrame, provider: Provider, reactions_a_batch: int = 16, batch: int = 8) -> DataFrame:
    """conditions (record_id, reaction_pos, condition_pos, role, text) with refined_role, role_source and role_reason.

    Specific roles stay. The others of a record are asked about in batches of neighbouring reactions, by their positions; a
    batch that fails, and every reaction of it that lacks a valid role for some condition, is asked about again reaction by
    reaction, and what is left gets its own role, if it is a known one, or else that of a reagent. Each level is a stored
    table, so that a lost executor repeats no request of the one before. Ids and positions aren't null and name a condition;
    null roles and texts are empty ones; an empty table gives an empty one. Answers:
    {"reactions": [{"reaction_index", "conditions": [{"condition_index", "refined_role", "reason"}]}]}.
    """
    plain = F.replace(F.lower(t.clean_text(F.col("role"))), F.lit("_"), F.lit(" "))
    given = conditions.select(*_AT, plain.alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    direct = given.filter(F.col("role").isin(*vocab.KEPT_ROLES))
    direct = direct.select(*_AT, "role", t.direct_role(F.col("role")).alias("refined_role"), F.lit("original").alias("role_source"), F.lit("already specific").alias("role_reason"))
    pending = given.filter(~F.col("role").isin(*vocab.KEPT_ROLES)).withColumn("_batch", F.floor(F.col("reaction_pos") / reactions_a_batch))
    first = materialize(_roles_answered(pending, ["record_id", "_batch"], provider, batch))
    open_ = first.groupBy("record_id", "reaction_pos").agg(F.bool_or(F.col("answered").isNull()).alias("open")).filter("open").drop("open")
    again = first.join(open_, ["record_id", "reaction_pos"], "left_semi").drop("answered")
    second = materialize(_roles_answered(again.select(*pending.columns), ["record_id", "reaction_pos"], provider, batch))
    settled = first.join(open_, ["record_id", "reaction_pos"], "left_anti").unionByName(second)
    own = F.when(F.col("role").isin(*vocab.REFINED_ROLES), F.col("role")).otherwise(F.lit(vocab.TERMINAL_ROLE))
    refined = settled.select(
        *_AT,
        "role",
        F.coalesce("answered.role", own).alias("refined_role"),
        F.when(F.col("answered").isNull(), "fallback").otherwise("refined").alias("role_source"),
        F.coalesce("answered.reason", F.lit("no valid answer")).alias("role_reason"),
    )
    made = direct.unionByName(refined).withColumnRenamed("role", "original_role")
    rest = [c for c in conditions.columns if c not in ("original_role", "refined_role", "role_source", "role_reason")]
    return conditions.select(*rest).join(made, _AT)


def role_counts(refined: DataFrame) -> DataFrame:
    """How many conditions, and how many of them by each source, a record and in all (record_id null)."""
    by = {s: F.count_if(F.col("role_source") == s).alias(s) for s in ("original", "refined", "fallback")}
    return refined.rollup("record_id").agg(F.count("*").alias("conditions"), *by.values())
