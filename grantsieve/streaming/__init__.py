"""Streaming entry points."""
