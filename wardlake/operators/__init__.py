"""Reusable DataFrame operators: skew-safe sequencing, interval counts, keys, table changes."""
