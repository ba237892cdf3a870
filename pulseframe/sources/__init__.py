"""Reading, writing and reusing tables."""
