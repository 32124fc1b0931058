"""Readers, normalisers and the symbol list."""
