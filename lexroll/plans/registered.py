"""All registered queries."""

from lexroll.plans import (  # noqa: F401
    growing_queries,
    model_queries,
    registry_queries,
    source_queries,
    stage_queries,
    text_queries,
    vector_queries,
    whole_stage_queries,
)
from lexroll.plans.catalog import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
