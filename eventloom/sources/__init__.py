"""Readers: stored tables, listing pages, and the adapter over the test tables."""
