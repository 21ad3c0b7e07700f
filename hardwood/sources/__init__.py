"""Readers for delimited files and prepared sets, and the matching writers."""
