"""Scalar column functions and SQL-name registration."""

from batchkit.functions.text import day_key, day_of, hash_block, java_split, java_trim

__all__ = ["day_key", "day_of", "hash_block", "java_split", "java_trim"]
