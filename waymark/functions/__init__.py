"""Column expressions: parsing, time parts, hashing, column resolution."""
