"""The queries of this package: ``opN_<name>`` and ``pipeline``, with their SQL where it exists."""

from __future__ import annotations

from .attention_mil import op12_gated_attention
from .exact_dedup import op10_content_sort
from .filter_audit import op11_counting_bloom_audit
from .merkle import op13_lag_lead_merkle
from .mixing import op4_splitting_tree
from .oracle import ORACLE_SQL as _SQL
from .packing import op7_deficit_round_robin
from .pii import op6_disclosure
from .preference import op8_preference_pairs
from .quality import op1_robust_outliers
from .secrets import op9_window_entropy
from .sharding import op5_communication_matrix
from .simhash import op2_pigeonring_simhash
from .suffix_dedup import op3_induced_suffix_sort

QUERIES = {f.__name__: f for f in (
    op1_robust_outliers, op2_pigeonring_simhash, op3_induced_suffix_sort, op4_splitting_tree,
    op5_communication_matrix, op6_disclosure, op7_deficit_round_robin, op8_preference_pairs,
    op9_window_entropy, op10_content_sort, op11_counting_bloom_audit, op12_gated_attention,
    op13_lag_lead_merkle)}

ORACLE_SQL = {k: v for k, v in _SQL.items() if k in QUERIES}
