"""Relational operators over the normalised tables."""
