"""Structured Streaming versions of collection, provider statistics and the registry."""
