"""The registered queries, grouped by SURVEY section 2 family."""

from topicspark.plans import q_audit, q_ingest, q_search, q_text  # noqa: F401
