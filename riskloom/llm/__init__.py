"""Operators for large training corpora: extraction, filtering, deduplication, decontamination, packing, search."""

from riskloom.llm import (  # noqa: F401
    query_decontaminate,
    query_exact_dedup,
    query_html,
    query_language,
    query_packing,
    query_quality,
    query_ranked,
    query_repeats,
    query_simhash,
    query_token_files,
    query_toxicity,
    query_warc,
    query_whitening,
)
from riskloom.llm.registry import ORACLES, QUERIES  # noqa: F401
