"""Reusable DataFrame operators (windows, sequences, key-replace, shares)."""
