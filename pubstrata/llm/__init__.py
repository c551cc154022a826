"""Operators for preparing training corpora (documents, embeddings, web pages)."""
