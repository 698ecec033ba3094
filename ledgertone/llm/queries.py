"""All queries of this subpackage."""

from ledgertone.llm import corpus_queries, drawing_queries, text_queries  # noqa: F401
from ledgertone.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
