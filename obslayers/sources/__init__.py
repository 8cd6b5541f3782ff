"""Topics and tables."""
