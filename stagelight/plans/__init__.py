"""Helpers that shape physical plans: shared-folder tables, hot keys, surrogate keys."""
