"""Incremental pick-up of newly landed objects."""
