"""Column expressions: no DataFrame, no I/O."""
