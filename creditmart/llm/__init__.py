"""Operators that prepare training data from a corpus of documents, pages and conversations."""
