"""Streaming use of the per-row operators (scaling with saved train statistics)."""
