"""Whole jobs, and the registered queries over the test tables."""
