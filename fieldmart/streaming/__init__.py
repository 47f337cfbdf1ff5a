"""Incremental forms of batch operators (Structured Streaming)."""
