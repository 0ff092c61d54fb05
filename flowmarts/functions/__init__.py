"""Column expressions: Column in, Column out, no DataFrame needed."""
