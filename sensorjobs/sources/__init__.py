"""Reads, writes and upserts."""
