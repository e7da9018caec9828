"""Column expressions, and the sequence kernels that no expression can say."""
