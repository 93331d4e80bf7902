"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from tripweave.llm import centroids, lexical
from tripweave.llm.byte_bpe import op4_byte_bpe
from tripweave.llm.centroids import op12_centroid_clusters
from tripweave.llm.jaccard import op3_jaccard_join
from tripweave.llm.language import language_id_pages, op6_language_id
from tripweave.llm.lexical import op13_lexical_search
from tripweave.llm.packing import op10_best_fit_packing
from tripweave.llm.pseudonyms import op5_pseudonyms
from tripweave.llm.rabitq import op7_rotated_codes
from tripweave.llm.secret_scan import op2_secret_scan
from tripweave.llm.suffix_dedup import op11_suffix_dedup
from tripweave.llm.toxicity import op8_toxicity
from tripweave.llm.substring_dedup import op9_substring_dedup
from tripweave.llm.topk import op1_topk_search

QUERIES = (op1_topk_search, op2_secret_scan, op3_jaccard_join, op4_byte_bpe, op5_pseudonyms, op6_language_id, op7_rotated_codes,
           op8_toxicity, op9_substring_dedup, op10_best_fit_packing, op11_suffix_dedup, op12_centroid_clusters, op13_lexical_search,
           language_id_pages)
#: The other results cannot be stated in SQL over the whole tables; tests/llm holds them against brute force.
ORACLES: dict[str, str] = {"op12_centroid_clusters": centroids.oracle(), "op13_lexical_search": lexical.oracle()}


def queries():
    return {f.__name__: f for f in QUERIES}


def oracle_sql():
    return dict(ORACLES)
