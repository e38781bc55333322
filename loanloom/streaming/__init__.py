"""Continuous scoring with Structured Streaming."""
