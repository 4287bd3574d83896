"""Column-level helpers: lenient parsing, JSON text, message keys, scalar expressions."""
