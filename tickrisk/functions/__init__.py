"""Column-expression helpers: IEEE arithmetic, parsing of wire fields."""
