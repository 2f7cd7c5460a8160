"""Readers for files, nested API pages and catalog tables."""
