"""All queries of the subpackage and the pipeline."""

import corpus_pipeline
from boxloom.llm import decontaminate, embeddings, lexical, licenses, mixing, quality, quotes, repair, scoring, secrets, sharding, simhash, substrings  # noqa: F401
from boxloom.llm.catalog import ORACLES, QUERIES

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
