"""Structured Streaming: incremental append of new JSON Lines files."""

from staylake.streaming.incremental import append_batch, load_available, start_incremental_load

__all__ = ["append_batch", "load_available", "start_incremental_load"]
