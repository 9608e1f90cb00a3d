"""Registered queries of this subpackage, with DuckDB SQL where SQL can express them.

The others (models, hashes, packings) are tested against brute force, exact round trips or held-out
accuracy in ``tests/llm``.
"""

from __future__ import annotations

from tillstar.llm import conversations, divergence, sharding
from tillstar.llm.ann import op5_nearest_neighbours
from tillstar.llm.conversations import op13_conversation_repair
from tillstar.llm.divergence import op11_source_divergence
from tillstar.llm.embed_dedup import op4_embedding_near_dedup
from tillstar.llm.jaccard import op8_jaccard_join
from tillstar.llm.lm import op1_lm_scoring
from tillstar.llm.mixing import op10_mixing
from tillstar.llm.packing import op3_best_fit_packing
from tillstar.llm.quality import op2_quality_classifier
from tillstar.llm.secrets import op7_secret_scans
from tillstar.llm.sharding import op12_sharding
from tillstar.llm.token_counts import op9_token_counts
from tillstar.llm.toxicity import op6_toxicity

QUERIES = {f.__name__: f for f in (
    op1_lm_scoring, op2_quality_classifier, op4_embedding_near_dedup, op5_nearest_neighbours, op3_best_fit_packing, op6_toxicity, op7_secret_scans, op8_jaccard_join, op9_token_counts, op10_mixing,
    op11_source_divergence, op12_sharding, op13_conversation_repair,
)}
ORACLE_SQL: dict[str, str] = {
    "op11_source_divergence": divergence.oracle_sql(), "op12_sharding": sharding.oracle_sql(), "op13_conversation_repair": conversations.oracle_sql(),
}
