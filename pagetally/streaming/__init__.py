"""Incremental steps driven by file arrival."""
