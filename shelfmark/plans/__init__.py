"""Whole runs: one pass over a backlog, and the stored index tables."""
