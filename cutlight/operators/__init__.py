"""Operators on timeline tables. Every table carries movie_id, and every join, window and group begins with it."""
