"""Column expressions and small DataFrame helpers (no UDFs)."""
