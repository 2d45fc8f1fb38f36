"""Structured Streaming sources, sinks and scoring."""
