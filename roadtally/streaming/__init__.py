"""Incremental forms of the summary and of the geocode enrichment."""
