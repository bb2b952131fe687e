"""Composite plans: dataset recipes, report queries and the TESTDATA registry."""
