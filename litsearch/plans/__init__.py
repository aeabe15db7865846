"""Chains of operators: enrichment, searches, and the queries over the test tables."""
