"""Structured Streaming entry points: incremental loads driven by arriving files."""

from sparkmarts.streaming.arrivals import start_order_fact_stream

__all__ = ["start_order_fact_stream"]
