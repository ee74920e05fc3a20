"""Column-returning helpers (built-in expressions only, no UDFs)."""
