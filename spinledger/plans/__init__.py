"""Whole runs, and the mapping of the registered queries."""
