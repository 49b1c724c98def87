"""Relational operators of the corpus flow; each is DataFrame -> DataFrame."""
