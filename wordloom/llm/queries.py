"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from wordloom.llm.divergence import OP13_SQL, op13_source_divergence_audit
from wordloom.llm.hamming import OP1_SQL, op1_hamming_top_k
from wordloom.llm.hard_negatives import OP12_SQL, op12_hard_negative_mining
from wordloom.llm.packing import op5_packing
from wordloom.llm.pii import op7_pii
from wordloom.llm.quality import op2_quality_rules
from wordloom.llm.quality_classifier import op11_quality_classifier
from wordloom.llm.sentencepiece_scan import op8_sentencepiece
from wordloom.llm.sharding import op6_sharding
from wordloom.llm.simhash import op10_simhash_near_dedup
from wordloom.llm.tokencount import op4_token_counts
from wordloom.llm.toxicity import op3_toxicity
from wordloom.llm.warc import OP9_SQL, op9_warc

QUERIES = {
    "op1_hamming_top_k": op1_hamming_top_k,
    "op2_quality_rules": op2_quality_rules,
    "op3_toxicity": op3_toxicity,
    "op4_token_counts": op4_token_counts,
    "op5_packing": op5_packing,
    "op6_sharding": op6_sharding,
    "op7_pii": op7_pii,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_warc": op9_warc,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_hard_negative_mining": op12_hard_negative_mining,
    "op13_source_divergence_audit": op13_source_divergence_audit,
}
ORACLES: dict[str, str] = {
    "op1_hamming_top_k": OP1_SQL,
    "op9_warc": OP9_SQL,
    "op12_hard_negative_mining": OP12_SQL,
    "op13_source_divergence_audit": OP13_SQL,
}
