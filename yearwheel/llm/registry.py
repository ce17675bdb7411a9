"""What the entry point adds to its queries."""

import corpus_pipeline

from yearwheel.llm import queries

QUERIES = queries.QUERIES | {"pipeline": corpus_pipeline.run}
ORACLE = queries.ORACLE | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})

__all__ = ["ORACLE", "QUERIES"]
