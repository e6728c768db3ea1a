"""Specifications of loads and processes, and the runs that carry them out."""
