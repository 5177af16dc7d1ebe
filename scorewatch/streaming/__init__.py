"""Structured Streaming forms of the monitoring reports."""
