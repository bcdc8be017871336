"""Timelines, editorial decisions and their audit trail for a catalog of titles, as Spark DataFrame operations."""
