"""Structured Streaming pipelines and their batch twins."""
