"""Adapters from the test tables to the dashboard records, and the query catalogue."""
