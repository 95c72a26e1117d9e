"""Ordered stages, the demonstration feed and the query catalogue."""
