"""Structured Streaming forms of the operators, and their sinks."""
