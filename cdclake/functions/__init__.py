"""Column functions: types and decoding, names and paths, redaction."""
