"""Column functions: text, hashes, JSON values, vectors."""
