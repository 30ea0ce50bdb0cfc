"""The queries of this subpackage."""

from __future__ import annotations

import corpus_pipeline
from lodestone.llm import exact_dedup, filter_audit, jaccard_join, mixing, packing, periodic_runs, quality, secrets, sharding, token_counts, token_files, toxicity, vector_search

MODULES = (secrets, vector_search, jaccard_join, sharding, mixing, token_counts, packing, toxicity, exact_dedup, quality, filter_audit, periodic_runs, token_files)

QUERIES: dict = {}
ORACLES: dict = {}
for module in MODULES:
    QUERIES.update(module.QUERIES)
    ORACLES.update(module.ORACLES)

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
