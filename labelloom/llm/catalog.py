"""The queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from labelloom.llm.conversation_repair import OP11_SQL, op11_repair
from labelloom.llm.decontamination import OP3_SQL, op3_decontamination
from labelloom.llm.language import op1_language
from labelloom.llm.mixing import OP10_SQL, op10_mixing
from labelloom.llm.nearest import op7_nearest
from labelloom.llm.periodic_runs import OP13_SQL, op13_runs
from labelloom.llm.personal_data import op2_personal_data
from labelloom.llm.plain_sql import OP6_SQL, OP8_SQL
from labelloom.llm.preferences import OP4_SQL, op4_preferences
from labelloom.llm.repeated_text import op8_repeated_text
from labelloom.llm.scoring import op5_scoring
from labelloom.llm.sharding import op9_sharding
from labelloom.llm.simhash import op12_simhash
from labelloom.llm.similar_texts import op6_similar_texts

QUERIES = {
    "op1_language": op1_language,
    "op2_personal_data": op2_personal_data,
    "op3_decontamination": op3_decontamination,
    "op4_preferences": op4_preferences,
    "op5_scoring": op5_scoring,
    "op6_similar_texts": op6_similar_texts,
    "op7_nearest": op7_nearest,
    "op8_repeated_text": op8_repeated_text,
    "op9_sharding": op9_sharding,
    "op10_mixing": op10_mixing,
    "op11_repair": op11_repair,
    "op12_simhash": op12_simhash,
    "op13_runs": op13_runs,
}

ORACLES = {
    "op3_decontamination": OP3_SQL,
    "op4_preferences": OP4_SQL,
    "op6_similar_texts": OP6_SQL,
    "op8_repeated_text": OP8_SQL,
    "op10_mixing": OP10_SQL,
    "op11_repair": OP11_SQL,
    "op13_runs": OP13_SQL,
}
