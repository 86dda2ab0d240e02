"""Typed reads, table writes, scratch space and job state."""
