"""The queries of this subpackage, and the SQL of those that SQL can express."""

from tidemark.llm.byte_pairs import op13_byte_pairs
from tidemark.llm.mixing import op3_mixing
from tidemark.llm.near_dedup import op4_minhash
from tidemark.llm.packing import op1_packing
from tidemark.llm.quality_classifier import op6_quality_classifier
from tidemark.llm.quality_rules import op5_quality_rules
from tidemark.llm.repeated_runs import op10_repeated_runs
from tidemark.llm.secrets import op7_secrets
from tidemark.llm.spelling import op12_spelling
from tidemark.llm.sql import SQL
from tidemark.llm.substring_dedup import op10_substring_dedup
from tidemark.llm.top_k import op8_top_k
from tidemark.llm.toxicity import op9_toxicity
from tidemark.llm.url_filter import op2_url_filter
from tidemark.llm.whitening import op11_whitening

QUERIES = {
    f.__name__: f
    for f in (
        op1_packing, op2_url_filter, op3_mixing, op4_minhash, op5_quality_rules, op6_quality_classifier, op7_secrets, op8_top_k, op9_toxicity,
        op10_substring_dedup, op10_repeated_runs, op11_whitening, op12_spelling, op13_byte_pairs,
    )
}

__all__ = ["QUERIES", "SQL"]
