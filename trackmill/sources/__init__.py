"""Readers: every one returns a DataFrame with a fixed schema."""
