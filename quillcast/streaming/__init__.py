"""Resumable incremental runs with Structured Streaming."""
