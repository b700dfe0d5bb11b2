"""Readers for messages, documents, archives and the benchmark tables."""
