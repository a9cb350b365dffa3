"""Structured Streaming landing."""
