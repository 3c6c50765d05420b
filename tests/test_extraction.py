"""Extraction in rounds: what goes round again, what ends it, what an audit adds, and screens that err."""

import json

from pyspark.sql import functions as F

from retort import extraction, schemas
from retort.operators import validation
from retort.providers import Dictionary

GOOD = {"id": "r1", "_gp_source": "A", "substrates": [{"name": "anisole"}], "products": [{"name": "biaryl"}], "catalysts": [{"name": "Pd"}], "conditions": {"solvent": "THF"}, "targets": {"yield": "90%"}}
JOBS = "job_id string, mode string, gp_keys array<string>, text string, prompt string"


class Script:
    """Answers by the job in a prompt and the number of the feedback lines; an answer that is an error is raised."""

    def __init__(self, answers):
        self.answers = answers

    def answer(self, keys):
        out = []
        for key in keys:
            job, *feedback = key.split("\n")
            found = self.answers[job]
            found = found(feedback) if callable(found) else found
            if isinstance(found, Exception):
                raise found
            out.append(found)
        return out


def told(word, before, after):
    return lambda feedback: after if any(word in f for f in feedback) else before


def jobs(spark, *names, mode="plain", keys=(), text=""):
    return spark.createDataFrame([(n, mode, list(keys), text, n) for n in names], JOBS)


def run(spark, answers, templates=None, **kw):
    found = extraction.extract(jobs(spark, *answers, **kw), Script(answers), templates)
    return {r.job_id: ([x.id for x in r.reactions], r.error, [a.kind for a in r.attempts]) for r in found.collect()}


def test_answers_of_every_shape(spark):
    texts = ['```json\n[{"id": "b"}, {"id": "a"}, 5]\n```', '{"reactions": [{"id": "x"}]}', '{"missing_reactions": []}', "nothing", "", None, '{"reactions": 3}', 'so: [{"id": "cut", "targets": {"yield": "9%"']
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, answer string")
    got = {r.k: r.reactions and [x.id for x in r.reactions] for r in extraction.parse_answers(rows, "k").collect()}
    assert got == {0: ["b", "a"], 1: ["x"], 2: [], 3: None, 4: None, 5: None, 6: None, 7: ["cut"]}
    assert extraction.parse_answers(rows.limit(0), "k").count() == 0


def test_only_failed_jobs_go_round_again(spark):
    good = json.dumps([GOOD])
    got = run(spark, {"fine": good, "none": "[]", "shape": told("schema", "no list", good), "broken": ValueError("down"), "blank": "  "})
    assert got["fine"] == (["r1"], None, []) and got["none"] == ([], None, [])
    assert got["shape"] == (["r1"], None, ["SchemaError"])
    assert got["broken"] == ([], extraction.FAILED, ["RequestFailed"] * 3) and got["blank"] == ([], extraction.FAILED, ["EmptyResponse"] * 3)
    assert run(spark, {}) == {}


def test_quality_is_asked_for_twice_and_then_let_be(spark):
    silent, bare = GOOD | {"targets": {}}, GOOD | {"substrates": [], "_gp_source": None}
    foreign = GOOD | {"_gp_source": "Z"}
    answers = {
        "mended": told("MissingTargets", json.dumps([silent]), json.dumps([GOOD])),
        "never": json.dumps([silent]),
        "bare": told("EmptySubstrates", json.dumps([bare]), json.dumps([GOOD])),
        "foreign": told("ForeignTemplate", json.dumps([foreign]), json.dumps([GOOD])),
        "several": told("MissingTargets", json.dumps([foreign | {"targets": {}}]), json.dumps([GOOD])),
    }
    got = run(spark, answers, mode="mixed", keys=["A"], text="gave 5% yield")
    assert got["mended"] == (["r1"], None, ["MissingTargets"]) and got["never"] == (["r1"], None, ["MissingTargets"] * 2)
    assert got["bare"][2] == ["EmptySubstrates"] and got["foreign"][2] == ["ForeignTemplate"] and got["several"][2] == ["SeveralLacks"]


def test_templates_ask_for_what_they_have(spark):
    template = {"substrates": [{"name": "s"}], "catalysts": [{"name": "Pd"}], "ligands": [{"name": " "}], "reaction_type": "coupling", "step_count": 2, "conditions": {"time": [{"value": "1 h"}], "solvent": [{"value": "THF"}]}}
    rows = spark.createDataFrame([("A", "valid", json.dumps(template)), ("B", "invalid", json.dumps(template))], "gp_key string, status string, t string")
    templates = rows.select("gp_key", "status", F.from_json("t", schemas.REACTION).alias("template"))
    one = [GOOD | {"catalysts": []}, GOOD | {"id": "", "_gp_source": None}]
    answers = {"x": json.dumps(one)}
    found = extraction.extract(jobs(spark, "x", mode="gp", keys=["A"]), Script(answers), templates).first()
    assert [a.message for a in found.attempts] == ["MissingTemplateFields: r1: catalysts, conditions.time, reaction_type, step_count; text_reaction_2: _gp_source, conditions.time, reaction_type, step_count"] * 2
    assert run(spark, answers, templates, mode="mixed", keys=["A"])["x"][2] == ["MissingTemplateFields"] * 2
    assert run(spark, {"x": json.dumps([GOOD | {"_gp_source": "B"}])}, templates, mode="gp", keys=["B"])["x"][2] == []


def test_audit_adds_what_is_new_once(spark):
    other = {"id": "r2", "substrates": ["b"], "products": ["c"], "targets": {"yield": "8%"}}
    work = jobs(spark, "a", "b", "c")
    outcomes = extraction.extract(work, Script({"a": json.dumps([GOOD]), "b": json.dumps([GOOD]), "c": ValueError("down")}))
    second = Script({"a": json.dumps({"missing_reactions": [GOOD | {"id": "again"}, other, other | {"id": "r3"}]}), "b": ValueError("down")})
    got = {r.job_id: ([x.id for x in r.reactions], r.audit_recovered) for r in extraction.audit(outcomes, work, second).collect()}
    assert got == {"a": (["r1", "r2"], 1), "b": (["r1"], 0), "c": ([], 0)}


def test_a_screen_that_errs_keeps_the_chunk(spark):
    chunks = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None), (5, "a")], "chunk_id int, text string")
    provider = Dictionary({"a": '{"has_reactions": true, "relevant_pages": [2]}', "b": '```json\n{"has_reactions": false}\n```', "c": "perhaps"})
    got = {r.chunk_id: (r.has_reactions, r.relevant_pages, r.screen_error) for r in extraction.screen(chunks, provider).collect()}
    assert got == {1: (True, [2], False), 2: (False, [], False), 3: (True, [], True), 4: (True, [], True), 5: (True, [2], False)}


def test_preview(spark):
    rows = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],), (None,)], "x array<string>")
    assert [r[0] for r in rows.select(validation.preview(F.col("x"), 2)).collect()] == ["a; b; ... (+1 more)", "a", "", ""]


ROLES = "record_id string, reaction_pos int, condition_pos int, role string, text string"


class Refiner:
    """Answers by the number of reactions in a request."""

    def __init__(self, batch, single):
        self.batch, self.single = batch, single

    def answer(self, keys):
        out = []
        for key in keys:
            several = len(json.loads(key)["reactions"]) > 1
            found = (self.batch if several else self.single)(json.loads(key))
            if isinstance(found, Exception):
                raise found
            out.append(found)
        return out


def roles(request, role="base"):
    return {"reactions": [{"reaction_index": r["reaction_index"], "conditions": [{"condition_index": c["condition_index"], "refined_role": role} for c in r["conditions"]]} for r in request["reactions"]]}


def refined(spark, rows, batch, single):
    out = extraction.refine_roles(spark.createDataFrame(rows, ROLES), Refiner(batch, single))
    return {(r.reaction_pos, r.condition_pos): (r.refined_role, r.role_source) for r in out.collect()}


def test_roles_fall_back_from_batches_to_reactions_to_their_own(spark):
    rows = [("a", 0, 0, "Solvent", "THF"), ("a", 0, 1, "agent", "K2CO3"), ("a", 1, 0, "unknown", "NaH"), ("a", 1, 1, None, None)]
    whole = lambda q: "```json\n" + json.dumps(roles(q)) + "\n```"
    refused = lambda q: ValueError("down")
    base = {(0, 0): ("solvent", "original"), (0, 1): ("base", "refined"), (1, 0): ("base", "refined"), (1, 1): ("base", "refined")}
    assert refined(spark, rows, whole, refused) == base, "no reaction is asked about again"
    assert refined(spark, rows, refused, whole) == base, "a batch that fails is parted"
    assert refined(spark, rows, refused, refused) == {**base, (0, 1): ("reagent", "fallback"), (1, 0): ("unknown", "fallback"), (1, 1): ("reagent", "fallback")}
    assert refined(spark, rows, lambda q: "no json", whole) == base == refined(spark, rows, lambda q: "[1]", whole)

    def half(q):  # the second reaction lacks a condition; the first has one twice, and one that wasn't asked about
        told = roles(q, "Ligand")
        told["reactions"][0]["conditions"] += [{"condition_index": 1, "refined_role": "time"}, {"condition_index": 0, "refined_role": "dr"}]
        del told["reactions"][1]["conditions"][1]
        return json.dumps(told)

    assert refined(spark, rows, half, whole) == {**base, (0, 1): ("ligand", "refined")}
    assert refined(spark, rows, half, lambda q: json.dumps(roles(q, "colour"))) == {**base, (0, 1): ("ligand", "refined"), (1, 0): ("unknown", "fallback"), (1, 1): ("reagent", "fallback")}
    assert refined(spark, [], whole, whole) == {}
