"""The data model: reactions, edges and what surrounds them, as Spark types."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retort.functions.vocab import EDGE_COLUMNS

STEP_VALUE = "struct<step:int,value:string>"
COMPOUND = (
    "struct<name:string,symbol:string,label:string,amount:string,step:int,scaffold:string,substituents:array<string>,parseable:boolean,"
    "iupac_name:string,smiles:string,original_name:string,resolved_name:string,resolved_iupac_name:string,resolved_smiles:string,"
    "resolution_source:string,resolution_method:string,resolution_confidence:string,resolution_status:string,registry_name:string,registry_match_status:string,"
    "resolved_name_normalized:string,text:string,resolution_evidence:struct<match_type:string,reported_name:string,reported_symbol:string,registry_symbol:string>>"
)
#: One value without a step, or one for each step: both are arrays, by key.
CONDITIONS = f"map<string,array<{STEP_VALUE}>>"
TARGETS = "struct<yield:string,ee:string,er:string,dr:string>"
INTERMEDIATE = "struct<name:string,symbol:string,produced_in_step:int,consumed_in_step:int>"
ROLES = ("substrates", "products", "catalysts", "ligands", "other_components", "additives", "reagents")
REACTION = (
    "struct<id:string,reaction_type:string,source_pages:array<int>,step_count:int,gp_source:string,"
    + ",".join(f"{r}:array<{COMPOUND}>" for r in ROLES)
    + f",intermediates:array<{INTERMEDIATE}>,conditions:{CONDITIONS},targets:{TARGETS}>"
)
#: Where a reaction stands: first-wins and renumbering follow it.
ORDER_KEY = ("paper_key", "source_modality", "file_pos", "reaction_pos")
EDGE = T.StructType([T.StructField(c, T.StringType()) for c in EDGE_COLUMNS])
SUMMARY_COLUMNS = ("paper", "location", "substrate", "product", "intermediate", "catalyst", "ligand", "solvent", "other_component", "conditions", "yield", "dr", "ee", "er", "review_1", "review_2")
TOKEN_EVENT = (
    "created_at timestamp, run_id string, stage string, pdf_name string, model string, operation string, status string, usage_present boolean,"
    " prompt_tokens long, completion_tokens long, total_tokens long, elapsed_seconds double"
)
TIMING_EVENT = "created_at timestamp, operation string, pdf_name string, image_name string, selected_area string, parent_operation string, status string, event_kind string, elapsed_seconds double, extra string"
GPU_SAMPLE = "created_at timestamp, elapsed_seconds double, gpu_index int, memory_used int, memory_total int, utilization int, power double, error string"


def compound(**fields: Column) -> Column:
    """A compound of these fields, the others null."""
    return F.struct(*[fields.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in re.findall(r"(\w+):(\w+<[^>]*>|\w+)", COMPOUND.removeprefix("struct<")[:-1])])
