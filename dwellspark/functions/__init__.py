"""Column functions with the exact semantics that the listing rules need."""
