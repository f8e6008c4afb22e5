"""Continuous runs."""
