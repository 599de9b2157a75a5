"""Operators that prepare training text and embeddings at scale."""
