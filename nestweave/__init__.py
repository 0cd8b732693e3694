"""Enrichment of deeply nested documents with Spark DataFrames and Structured Streaming."""

from nestweave.operators.conform import conform
from nestweave.operators.dimension import last_wins_dimension
from nestweave.operators.lookup import NOT_FOUND, Domain, enrich
from nestweave.schemas import document_schema, enriched_schema

__all__ = [
    "NOT_FOUND",
    "Domain",
    "conform",
    "document_schema",
    "enrich",
    "enriched_schema",
    "last_wins_dimension",
]
