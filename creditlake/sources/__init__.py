"""Reading raw extracts and writing tables."""
