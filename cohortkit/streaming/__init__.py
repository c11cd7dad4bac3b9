"""Incremental (Structured Streaming) use of the batch operators."""
