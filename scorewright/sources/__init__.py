"""Readers (A1-A5) and writers."""
