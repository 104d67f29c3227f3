"""Readers and writers: record lists, tables, corpora, step state, report text."""
