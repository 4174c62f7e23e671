"""Registered queries of the corpus operators: name -> (function, SQL twin or None)."""

from __future__ import annotations

from canvass.llm.chat_format import OP10_SQL, op10_chat_format
from canvass.llm.decontaminate import OP4_SQL, op4_decontamination
from canvass.llm.embedding_dedup import op13_embedding_duplicates
from canvass.llm.fill_in_middle import OP12_SQL, op12_fill_in_middle
from canvass.llm.line_dedup import op1_line_dedup
from canvass.llm.near_duplicates import op5_near_duplicates
from canvass.llm.nearest_vectors import op3_nearest_vectors
from canvass.llm.packing import op6_packing
from canvass.llm.periodic_runs import op11_periodic_runs
from canvass.llm.personal_data import op8_personal_data
from canvass.llm.suffix_dedup import op9_suffix_dedup
from canvass.llm.toxicity import op7_toxicity
from canvass.llm.url_filter import OP2_SQL, op2_url_filter

LLM_QUERIES = {
    "op1_line_dedup": (op1_line_dedup, None),
    "op2_url_filter": (op2_url_filter, OP2_SQL),
    "op3_nearest_vectors": (op3_nearest_vectors, None),
    "op4_decontamination": (op4_decontamination, OP4_SQL),
    "op5_near_duplicates": (op5_near_duplicates, None),
    "op6_packing": (op6_packing, None),
    "op7_toxicity": (op7_toxicity, None),
    "op8_personal_data": (op8_personal_data, None),
    "op9_suffix_dedup": (op9_suffix_dedup, None),
    "op10_chat_format": (op10_chat_format, OP10_SQL),
    "op11_periodic_runs": (op11_periodic_runs, None),
    "op12_fill_in_middle": (op12_fill_in_middle, OP12_SQL),
    "op13_embedding_duplicates": (op13_embedding_duplicates, None),
}
