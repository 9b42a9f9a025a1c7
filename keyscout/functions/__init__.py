"""Column expressions. Everything here is a plain Catalyst expression, no UDFs."""
