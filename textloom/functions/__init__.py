"""Scalar column functions: no Python runs for a row."""
