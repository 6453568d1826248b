"""Derived views and the registered queries with their SQL twins."""

from wardlake.plans import (  # noqa: F401
    access_queries, audit_queries, classification_queries, common_queries, fleet_queries,
    masking_queries, report_queries, stream_queries, token_queries,
)
from wardlake.plans.registry import QUERIES  # noqa: F401
