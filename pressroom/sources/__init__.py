"""Reading landed data, and writing tables."""
