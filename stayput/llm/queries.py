"""Registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from stayput.llm import (audit, decontaminate, embeddings, exact_dedup, language, licenses, lines, mixing, packing, quality, sharding, simhash,
                         trie)

QUERIES = {
    "op1_license_scan": licenses.op1_license_scan,
    "op2_line_dedup": lines.op2_line_dedup,
    "op3_embedding_near_dedup": embeddings.op3_embedding_near_dedup,
    "op4_mixing": mixing.op4_mixing,
    "op5_sharding": sharding.op5_sharding,
    "op6_quality": quality.op6_quality,
    "op7_simhash_near_dedup": simhash.op7_simhash_near_dedup,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_language_id": language.op9_language_id,
    "op10_packing": packing.op10_packing,
    "op11_decontamination": decontaminate.op11_decontamination,
    "op12_filter_audit": audit.op12_filter_audit,
    "op13_conversation_trie": trie.op13_conversation_trie,
    "pipeline": corpus_pipeline.run,
}
ORACLE = {
    "op8_exact_dedup": exact_dedup.OP8_SQL,
    "op11_decontamination": decontaminate.OP11_SQL,
    "op12_filter_audit": audit.OP12_SQL,
    "op13_conversation_trie": trie.OP13_SQL,
}
