"""Column builders (no actions): parsing, arithmetic, flags, bins, hashing."""
