"""Whole jobs: the load, the served queries, and the queries over the shared test tables."""
