"""Compositions: the report, incremental steps, named steps."""
