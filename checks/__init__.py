"""Driver queries: the operators and models run over the given tables."""
