"""Distributed plan shapes that several operators share."""
