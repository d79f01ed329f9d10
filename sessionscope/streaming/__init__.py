"""Structured Streaming form of the session statistics."""

from sessionscope.streaming.sessions import (
    session_rollup_stream, start_stat_increments, stats_from_increments,
)

__all__ = ["session_rollup_stream", "start_stat_increments", "stats_from_increments"]
