"""Structured Streaming forms of the periodic reports."""
