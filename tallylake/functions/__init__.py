"""Column functions: masking and presentation."""
