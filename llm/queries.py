"""One registered query per operator, the pipeline, and their SQL."""

from __future__ import annotations

import corpus_pipeline
from llm.ann import op8_nearest
from llm.bpe import op3_bpe
from llm.chat import ORACLE as CHAT_ORACLE
from llm.chat import op5_chat
from llm.divergence import ORACLE as DIVERGENCE_ORACLE
from llm.divergence import op11_divergence
from llm.fmquality import op13_quality_classifier
from llm.licenses import ORACLE as LICENSE_ORACLE
from llm.licenses import op9_licenses
from llm.linedup import ORACLE as LINE_ORACLE
from llm.linedup import op1_line_dedup
from llm.lm import op2_lm_scoring
from llm.neardup import ORACLE as NEAR_ORACLE
from llm.neardup import op6_near_duplicates
from llm.packing import op10_packing
from llm.quality import op7_quality
from llm.sharding import op4_sharding
from llm.veccodes import ORACLE as CODE_ORACLE
from llm.veccodes import op12_vector_codes

OPERATORS = [
    op1_line_dedup, op2_lm_scoring, op3_bpe, op4_sharding, op5_chat, op6_near_duplicates, op7_quality, op8_nearest, op9_licenses,
    op10_packing, op11_divergence, op12_vector_codes, op13_quality_classifier,
]
QUERIES = {f.__name__: f for f in OPERATORS}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLES: dict[str, str] = {
    "op1_line_dedup": LINE_ORACLE,
    "op5_chat": CHAT_ORACLE,
    "op6_near_duplicates": NEAR_ORACLE,
    "op9_licenses": LICENSE_ORACLE,
    "op11_divergence": DIVERGENCE_ORACLE,
    "op12_vector_codes": CODE_ORACLE,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
