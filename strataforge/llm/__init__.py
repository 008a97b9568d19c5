"""Operators for preparing training text and embeddings.  Nothing else in the library imports this package."""
