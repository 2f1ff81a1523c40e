"""Whole runs as DataFrame plans."""
