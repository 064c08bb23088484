"""Scoring and monitoring as Structured Streaming jobs."""
