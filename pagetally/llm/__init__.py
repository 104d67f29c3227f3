"""Operators for training-data corpora: documents, pages, conversations and embeddings."""
