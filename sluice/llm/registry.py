"""The training-data queries: name -> (callable, DuckDB SQL or None)."""

from __future__ import annotations

from sluice.llm.bpe_codec import op2_bpe_codec
from sluice.llm.exact_dedup import OP3_SQL, op3_exact_dedup
from sluice.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from sluice.llm.mixing import OP10_SQL, op10_mixing
from sluice.llm.near_vectors import op1_near_vectors
from sluice.llm.ngram_join import op9_ngram_join
from sluice.llm.pii_spans import op5_pii
from sluice.llm.quality import op7_quality
from sluice.llm.secret_scan import op12_secret_scan
from sluice.llm.source_divergence import OP11_SQL, op11_source_divergence
from sluice.llm.suffix_dedup import op8_suffix_dedup
from sluice.llm.token_counts import op6_token_counts
from sluice.llm.url_filters import op4_url_filters

QUERIES = {
    "op1_near_vectors": (op1_near_vectors, None),
    "op2_bpe_codec": (op2_bpe_codec, None),
    "op3_exact_dedup": (op3_exact_dedup, OP3_SQL),
    "op4_url_filters": (op4_url_filters, None),
    "op5_pii": (op5_pii, None),
    "op6_token_counts": (op6_token_counts, None),
    "op7_quality": (op7_quality, None),
    "op8_suffix_dedup": (op8_suffix_dedup, None),
    "op9_ngram_join": (op9_ngram_join, None),
    "op10_mixing": (op10_mixing, OP10_SQL),
    "op11_source_divergence": (op11_source_divergence, OP11_SQL),
    "op12_secret_scan": (op12_secret_scan, None),
    "op13_hard_negatives": (op13_hard_negatives, OP13_SQL),
}
