"""Structured Streaming variants of the ingestion and fact upsert."""
