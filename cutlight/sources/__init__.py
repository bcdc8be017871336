"""Subtitle, metadata and file sources, and sinks."""
