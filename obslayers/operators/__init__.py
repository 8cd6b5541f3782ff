"""Cleaning, aggregation, preview and report operators."""
