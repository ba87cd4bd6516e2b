"""Structured Streaming use of the library's stateless jobs (the reference itself has no streaming)."""

from periodix.streaming.spread_stream import plan_spread_stream, start_plan_spread  # noqa: F401
