"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

import corpus_pipeline
from starloom.llm.decontaminate import op10_decontaminate
from starloom.llm.jaccard import op9_jaccard_join
from starloom.llm.langid import op1_language_id
from starloom.llm.license import op6_license_scan
from starloom.llm.linededup import SQL as LINE_SQL
from starloom.llm.linededup import op2_line_dedup
from starloom.llm.lm import op5_lm_scores
from starloom.llm.packing import op13_packing
from starloom.llm.permutation import op8_nearest_neighbours
from starloom.llm.pieces import op7_sentencepiece
from starloom.llm.repair import op12_conversation_repair
from starloom.llm.surrogates import op4_surrogates
from starloom.llm.warc import op3_warc
from starloom.llm.whitening import op11_whitening

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_line_dedup": op2_line_dedup,
    "op3_warc": op3_warc,
    "op4_surrogates": op4_surrogates,
    "op5_lm_scores": op5_lm_scores,
    "op6_license_scan": op6_license_scan,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_decontaminate": op10_decontaminate,
    "op11_whitening": op11_whitening,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_packing": op13_packing,
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {"op2_line_dedup": LINE_SQL}
if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
