"""Whole retrieval jobs composed from the operators."""
