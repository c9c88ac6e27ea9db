"""Landed inputs: change messages, harvest pages and repository tables."""
