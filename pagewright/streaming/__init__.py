"""Streaming of the layout engine."""
