"""Column functions: message decoding, times and units."""
