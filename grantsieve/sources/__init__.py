"""Readers for catalogues and landed pages."""
