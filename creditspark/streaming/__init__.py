"""Structured Streaming entry points (stateless scoring, running stage ECL)."""

from .scoring import (read_order_stream, running_stage_ecl, score_stream, start_running_stage_ecl,
                      start_scored_sink, static_customers)

__all__ = ["read_order_stream", "running_stage_ecl", "score_stream", "start_running_stage_ecl",
           "start_scored_sink", "static_customers"]
