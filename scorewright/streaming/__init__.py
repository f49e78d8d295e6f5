"""Structured Streaming versions of verdict scoring, request state and running averages."""
