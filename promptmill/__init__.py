"""Prompt-corpus curation and run-log analytics expressed as Spark DataFrame operations."""
