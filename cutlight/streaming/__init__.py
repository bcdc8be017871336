"""Operators on the append-only stage log as a stream."""
