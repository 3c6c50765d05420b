"""The operators' queries, and their SQL where SQL can express them."""

from retort.llm.chat import OP8_SQL, op8_chat
from retort.llm.collocations import OP13_SQL, op13_collocations
from retort.llm.decontamination import OP7_SQL, op7_decontamination
from retort.llm.fingerprints import op2_fingerprints
from retort.llm.html_text import op1_html
from retort.llm.language import op3_language
from retort.llm.merkle import OP11_SQL, op11_merkle
from retort.llm.neardup import OP5_SQL, op5_neardup
from retort.llm.packing import op10_packing
from retort.llm.quality import op4_quality
from retort.llm.scoring import op6_scoring
from retort.llm.secrets import op12_secrets
from retort.llm.sharding import op9_sharding

QUERIES = {
    "op1_html": op1_html,
    "op2_fingerprints": op2_fingerprints,
    "op3_language": op3_language,
    "op4_quality": op4_quality,
    "op5_neardup": op5_neardup,
    "op6_scoring": op6_scoring,
    "op7_decontamination": op7_decontamination,
    "op8_chat": op8_chat,
    "op9_sharding": op9_sharding,
    "op10_packing": op10_packing,
    "op11_merkle": op11_merkle,
    "op12_secrets": op12_secrets,
    "op13_collocations": op13_collocations,
}
ORACLE_SQL = {
    "op5_neardup": OP5_SQL,
    "op7_decontamination": OP7_SQL,
    "op8_chat": OP8_SQL,
    "op11_merkle": OP11_SQL,
    "op13_collocations": OP13_SQL,
}
