"""Registered queries, one module per build milestone."""

from loadcast.queries import (  # noqa: F401  (import registers)
    q_cleaning,
    q_summaries,
    q_ingest,
    q_drift,
    q_forecast,
    q_anomaly,
    q_streaming,
    q_jobs,
)
from loadcast.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
