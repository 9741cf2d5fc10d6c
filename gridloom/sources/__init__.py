"""Readers and writers: tables, feature metadata, result files."""
