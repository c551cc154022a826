"""Column-expression helpers: vectors, statistics, keys, text."""
