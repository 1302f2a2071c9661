"""Sinks: text folders, partitioned tables, views."""
