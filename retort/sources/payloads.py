"""Readers of reaction payloads, pages and event logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retort import schemas
from retort.functions import metrics as m
from retort.functions import text as t


def read_payloads(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """file, payload (VARIANT) of every file that holds a JSON object; others are left out, by name order of the files."""
    raw = spark.read.text(path, wholetext=True, pathGlobFilter=glob).select(F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("payload"))
    return raw.filter(F.schema_of_variant("payload").startswith("OBJECT"))


def read_image_payloads(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """As read_payloads(), only those with a list of reactions."""
    found = read_payloads(spark, path, glob)
    return found.filter(F.schema_of_variant(F.try_variant_get("payload", "$.reactions", "variant")).startswith("ARRAY"))


def _text(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def _conditions(raw: Column) -> Column:
    """Each key's scalar, or its list of {step, value}, as an array of step and value."""
    kind = lambda v: F.schema_of_variant(v)
    fields = F.coalesce(F.try_variant_get(raw, "$", "map<string,variant>"), F.expr("cast(map() as map<string,variant>)"))

    def values(v: Column) -> Column:
        items = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.struct(t.step_number(_text(x, "$.step")).alias("step"), _text(x, "$.value").alias("value")))
        one = F.array(F.struct(F.lit(None).cast("int").alias("step"), _text(v, "$").alias("value")))
        return F.filter(F.when(kind(v).startswith("ARRAY"), items).otherwise(one), lambda x: t.clean_text(x["value"]) != "")

    return F.map_filter(F.transform_values(fields, lambda _, v: values(v)), lambda _, v: F.size(v) > 0)


def _compounds(raw: Column) -> Column:
    """The compounds of one role: a scalar is a list of one, a bare text a compound of that name, anything else is left out."""
    kind = F.schema_of_variant(raw)
    items = F.when(kind.startswith("ARRAY"), F.try_variant_get(raw, "$", "array<variant>")).when(raw.isNotNull() & (kind != "VOID"), F.array(raw)).otherwise(F.expr("cast(array() as array<variant>)"))
    items = F.filter(items, lambda v: F.schema_of_variant(v).startswith("OBJECT") | (F.schema_of_variant(v) == "STRING"))
    plain = lambda name: F.from_json(F.to_json(F.struct(name.alias("name"))), schemas.COMPOUND)
    return F.transform(items, lambda v: F.when(F.schema_of_variant(v) == "STRING", plain(_text(v, "$"))).otherwise(F.from_json(F.to_json(v), schemas.COMPOUND)))


def reactions_of(payloads: DataFrame, modality: str = "text") -> DataFrame:
    """One row for each reaction: the order key, the paper's name and `reaction` as in schemas.REACTION."""
    top = lambda *names: F.coalesce(*[F.nullif(t.clean_text(_text(F.col("payload"), f"$.{n}")), F.lit("")) for n in names])
    named = payloads.select("file", "payload", t.paper_name(top("paper_key", "metadata.paper_key", "source_paper"), _text(F.col("payload"), "$.source"), F.col("file")).alias("source_paper"))
    rows = named.select("file", "source_paper", F.posexplode(F.try_variant_get("payload", "$.reactions", "array<variant>")).alias("reaction_pos", "r"))
    rows = rows.filter(F.schema_of_variant("r").startswith("OBJECT"))
    r = F.col("r")
    metric = lambda m: F.coalesce(F.nullif(_text(r, f"$.targets.{m}"), F.lit("")), _text(r, f"$.{m}")).alias(m)
    number = F.coalesce(F.nullif(t.clean_text(_text(r, "$.id")), F.lit("")), F.concat(F.lit("text_reaction_"), F.col("reaction_pos") + 1))
    body = F.struct(
        number.alias("id"),
        _text(r, "$.reaction_type").alias("reaction_type"),
        t.page_numbers(F.to_json(F.try_variant_get(r, "$.source_pages", "variant"))).alias("source_pages"),
        F.try_variant_get(r, "$.step_count", "int").alias("step_count"),
        _text(r, "$._gp_source").alias("gp_source"),
        *[_compounds(F.try_variant_get(r, f"$.{role}", "variant")).alias(role) for role in schemas.ROLES],
        F.try_variant_get(r, "$.intermediates", f"array<{schemas.INTERMEDIATE}>").alias("intermediates"),
        _conditions(F.try_variant_get(r, "$.conditions", "variant")).alias("conditions"),
        F.struct(*[metric(m) for m in ("yield", "ee", "er", "dr")]).alias("targets"),
    )
    return rows.select(t.paper_key(F.col("file")).alias("paper_key"), F.lit(modality).alias("source_modality"), F.col("file").alias("file_pos"), "reaction_pos", "source_paper", body.alias("reaction"))


def image_reactions_of(payloads: DataFrame) -> DataFrame:
    """As reactions_of(), of image records; those with an error are left out. Reactants are substrates, and the condition
    rows of a reaction go to catalysts (ligands too), additives, reagents, conditions or targets by their effective role."""
    v = F.col("payload")
    head = payloads.filter(F.coalesce(F.lower(_text(v, "$.status")), F.lit("ok")) != "error").select("file", t.paper_name(_text(v, "$.pdf_name"), _text(v, "$.pdf_name"), F.col("file")).alias("source_paper"), F.coalesce(_text(v, "$.image_name"), F.lit("")).alias("source_image"), F.posexplode(F.try_variant_get(v, "$.reactions", "array<variant>")).alias("reaction_pos", "r"))
    r = F.col("r")
    listed = F.coalesce(F.try_variant_get(r, "$.conditions", "array<variant>"), F.expr("cast(array() as array<variant>)"))
    role = lambda x: t.direct_role(t.effective_role(_text(x, "$.refined_role"), F.coalesce(_text(x, "$.original_role"), _text(x, "$.role"))))
    said = lambda x: t.first_text(_text(x, "$.text"), _text(x, "$.label"), _text(x, "$.iupac_name"), _text(x, "$.smiles"))
    rows = F.transform(listed, lambda x: F.struct(role(x).alias("role"), said(x).alias("value"), x.alias("x")))
    of = lambda test: F.filter("rows", lambda c: test(c["role"]))
    outcome, setting = ("yield", "ee", "er", "dr"), ("solvent", "temperature", "time", "concentration", "volume", "atmosphere", "light", "wavelength")
    compound = lambda c: F.from_json(F.to_json(F.struct(t.strip_amounts(c["value"]).alias("name"), _text(c["x"], "$.smiles").alias("smiles"), _text(c["x"], "$.iupac_name").alias("iupac_name"), _text(c["x"], "$.label").alias("label"), F.nullif(m.extract_amount(c["value"]), F.lit("")).alias("amount"))), schemas.COMPOUND)
    compounds = lambda test: F.transform(of(test), compound)
    known = ("catalyst", "ligand", "additive", "base", *outcome, *setting)
    empty = F.expr(f"cast(array() as array<{schemas.COMPOUND}>)")
    target = lambda k: F.try_element_at(F.transform(of(lambda x: x == k), lambda c: c["value"]), F.lit(1)).alias(k)
    values = lambda k: F.transform(of(lambda x: x == k), lambda c: F.struct(F.lit(None).cast("int").alias("step"), c["value"].alias("value")))
    settings = F.map_filter(F.map_from_entries(F.array(*[F.struct(F.lit(k).alias("key"), values(k).alias("value")) for k in setting])), lambda _, v: F.size(v) > 0)
    parts = {
        "substrates": _compounds(F.try_variant_get(r, "$.reactants", "variant")),
        "products": _compounds(F.try_variant_get(r, "$.products", "variant")),
        "catalysts": compounds(lambda x: x.isin("catalyst", "ligand")),
        "additives": compounds(lambda x: x.isin("additive", "base")),
        "reagents": compounds(lambda x: ~x.isin(*known)),
    }
    body = F.struct(
        F.coalesce(F.nullif(t.clean_text(_text(r, "$.reaction_id")), F.lit("")), F.concat(F.lit("image_reaction_"), F.col("reaction_pos") + 1)).alias("id"),
        _text(r, "$.reaction_type").alias("reaction_type"),
        F.lit(None).cast("array<int>").alias("source_pages"),
        F.lit(None).cast("int").alias("step_count"),
        F.lit(None).cast("string").alias("gp_source"),
        *[parts.get(k, empty).alias(k) for k in schemas.ROLES],
        F.lit(None).cast(f"array<{schemas.INTERMEDIATE}>").alias("intermediates"),
        settings.alias("conditions"),
        F.struct(*[target(k) for k in outcome]).alias("targets"),
    )
    return head.withColumn("rows", rows).select(t.paper_key(F.col("file")).alias("paper_key"), F.lit("image").alias("source_modality"), F.col("file").alias("file_pos"), "reaction_pos", "source_paper", "source_image", body.alias("reaction"))


def explode_compounds(reactions: DataFrame, roles: tuple[str, ...] = schemas.ROLES) -> DataFrame:
    """order key, field, item_pos and compound of each compound of each role, in one pass over the reactions."""
    placed = lambda role: F.transform(F.coalesce(F.col(f"reaction.{role}"), F.array()), lambda c, i: F.struct(F.lit(role).alias("field"), i.alias("item_pos"), c.alias("compound")))
    per_role = F.flatten(F.array(*[placed(role) for role in roles]))
    return reactions.select(*schemas.ORDER_KEY, "source_paper", "reaction.id", F.inline(per_role))


def read_events(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a JSON-lines log; lines that aren't objects of the schema are left out."""
    return spark.read.schema(schema).json(path, mode="DROPMALFORMED")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A table with a header, whose first name may carry a byte order mark."""
    found = spark.read.csv(path, header=True)
    return found.toDF(*[c.removeprefix("﻿") for c in found.columns])


def read_paper_map(spark: SparkSession, path: str) -> DataFrame:
    """paper_key, si_file and pdf_file of a table in which these columns have one of several names."""
    found = read_csv(spark, path)
    names = {"paper_key": ("paper_key", "paper", "key"), "si_file": ("si_file", "si", "si_pdf"), "pdf_file": ("pdf_file", "pdf", "main_pdf")}
    pick = lambda options: F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in options if c in found.columns], F.lit(None).cast("string"))
    return found.select(*[pick(options).alias(name) for name, options in names.items()])


def list_files(spark: SparkSession, path: str, part: str = "", limit: int | None = None) -> DataFrame:
    """file and length of the files whose name holds `part`, by name; the first `limit` of them if given."""
    found = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "length")
    found = found.filter(F.contains(F.lower("file"), F.lit(part.lower()))).orderBy("file")
    return found if limit is None else found.limit(limit)


def gpu_samples(lines: Column) -> Column:
    """struct of a "index, used, total[, utilization]" line; fields that aren't numbers are null."""
    part = lambda i: t.strip(F.try_element_at(F.split(lines, ","), F.lit(i + 1))).try_cast("int")
    return F.struct(part(0).alias("gpu_index"), part(1).alias("memory_used"), part(2).alias("memory_total"), part(3).alias("utilization"))


def split_pages(texts: DataFrame, column: str = "text") -> DataFrame:
    """page_num and text of each "--- Page N ---" part of a text; blank pages are left out, so numbers have gaps."""
    parts = F.filter(F.transform(F.split(column, r"(?=--- Page\s+\d+\s+---)"), lambda p: F.struct(F.regexp_extract(p, r"\A--- Page\s+(\d+)\s+---", 1).try_cast("int").alias("page_num"), t.strip(F.regexp_replace(p, r"\A--- Page\s+\d+\s+---", "")).alias("text"))), lambda p: p["page_num"].isNotNull() & (p["text"] != ""))
    return texts.select(*[c for c in texts.columns if c != column], F.inline(parts))
