"""Structured Streaming forms of the operators that need it."""
