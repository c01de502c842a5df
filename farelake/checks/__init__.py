"""Queries over the check tables, each with an equivalent in plain SQL."""
