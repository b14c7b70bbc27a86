"""All queries of this subpackage, gathered from its query modules."""

from __future__ import annotations

import corpus_pipeline  # noqa: F401
from zonewright.llm import (  # noqa: F401
    bpe_queries,
    collocation_queries,
    decontamination_queries,
    html_queries,
    jaccard_queries,
    nbsvm_queries,
    preference_queries,
    prefix_trie_queries,
    quality_queries,
    suffix_queries,
    token_queries,
    url_queries,
    warc_queries,
)
from zonewright.llm.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
