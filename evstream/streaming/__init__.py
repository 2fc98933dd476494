"""Structured Streaming: starting and restarting queries, keyed state, streaming jobs."""
