"""Finding, reading, decoding and writing tables."""
