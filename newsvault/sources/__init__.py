"""Readers for landed feed files, seeds and named tables."""
