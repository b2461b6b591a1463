"""Column functions: text, space and similarity."""
