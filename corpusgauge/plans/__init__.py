"""Whole jobs made of several operators: corpus audit, distribution audit, fetch gate."""
