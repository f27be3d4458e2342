"""The queries of this subpackage, by name, and their SQL."""

import corpus_pipeline

from .embeddings import OP6_SQL, op6_near_vectors
from .html import op1_html_extraction
from .minhash import OP9_SQL, op9_minhash
from .mixing import op2_mixing
from .packing import op5_packing
from .quality import OP3_SQL, op3_quality_rules
from .suffixes import OP4_SQL, op4_repeats
from .tokencounts import op10_token_counts
from .toxicity import op8_toxicity
from .urls import OP7_SQL, op7_url_filter

QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_mixing": op2_mixing,
    "op3_quality_rules": op3_quality_rules,
    "op4_repeats": op4_repeats,
    "op5_packing": op5_packing,
    "op6_near_vectors": op6_near_vectors,
    "op7_url_filter": op7_url_filter,
    "op8_toxicity": op8_toxicity,
    "op9_minhash": op9_minhash,
    "op10_token_counts": op10_token_counts,
    "pipeline": corpus_pipeline.run,
}
SQL = {"op3_quality_rules": OP3_SQL, "op4_repeats": OP4_SQL, "op6_near_vectors": OP6_SQL, "op7_url_filter": OP7_SQL, "op9_minhash": OP9_SQL}
