"""Every registered query."""

from wardlog.plans import feature_queries, job_queries, model_queries, parse_queries, report_queries, stream_queries  # noqa: F401
from wardlog.plans.registry import ORACLES, QUERIES  # noqa: F401
