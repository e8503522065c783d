"""Readers, and adapters from the shared tables to the streams."""
