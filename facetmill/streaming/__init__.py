"""Streaming forms."""
