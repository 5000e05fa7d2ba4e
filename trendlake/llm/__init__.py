"""Operators for preparing training corpora (documents, embeddings,
conversations). Nothing else in the library imports this subpackage."""
