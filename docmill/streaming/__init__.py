"""Streaming of docmill."""
