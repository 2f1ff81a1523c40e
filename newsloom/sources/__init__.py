"""Readers and item sources."""
